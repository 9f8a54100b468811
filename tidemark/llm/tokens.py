"""Document token ids of the word-level BPE vocabulary, encoded once per distinct chunk.

The vocabulary's rules drop white space and look at nothing beyond it. They lower every letter, and a run of letters,
one digit and a run of signs are words of their own, so the ids of a text are those of its chunks in a row: chunks
begin at white space, and where two classes meet or two digits do. Classes are known of ASCII but for the apostrophe,
which may start a part of its own, and of Latin letters (U+017F at most) that NFC leaves alone and that have one lower
letter; all else stays with its neighbours up to the next such place. Some MB of texts are parted at once, each distinct
chunk is looked up once, and the ids are laid out by the chunks' numbers. A worker keeps the chunks it has seen (a
bounded number) and hands only new ones to the tokenizer library. Words of letters need only be lowered and spelt in
bytes, which is done here for all of them at once: they are parted by white space, and the model's end-of-word ids tell
them apart again. The other chunks go through the rules, with a separator between them. Added tokens are matched in the
raw text, so a text that holds the string of one, in any case, is given to the library whole, and so is one in which a
capital lowered before NFC might compose with a mark.
"""

from __future__ import annotations

import codecs
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Chunks a worker keeps before it starts anew; those it kept before stay at hand for as many more. Some 250 MB.
KEPT_CHUNKS = 600_000
END_ID = 1
#: Stands between chunks; were it part of one, more of its ids would come back than were put in.
_SEPARATOR = "\x01"

#: Bytes of texts that are parted at once.
GROUP_BYTES = 4 << 20

#: Capitals that only compose with a mark (U+0300 to U+033F, which start with byte CC) once they are lowered, after NFC.
_COMPOSED_WHEN_LOWERED = re.compile(rb"[HJTWY][^\x00-\x7f]").search


def _spelling() -> str:
    """The letter that stands for each byte in a byte-level vocabulary; white space stays, as it parts words here."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
    return "".join(" " if b == 32 else letters[b] for b in range(256))


_SPELLING = _spelling()

#: Classes of bytes; what no class is known of glues its neighbours.
_SPACE, _LETTER, _DIGIT, _SIGN, _GLUE, _LEAD = range(6)


def _class(byte: int) -> int:
    if byte >= 0x80:
        return _LEAD if 0xC3 <= byte <= 0xC5 else _GLUE
    c = chr(byte)
    return _SPACE if c == " " else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SIGN if c.isprintable() and c != "'" else _GLUE


#: ASCII capitals are lowered, and all white space is a space.
_PLAIN = bytes(32 if b in b"\t\n\v\f\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_CLASSES = bytes(map(_class, range(256)))
#: Whether a chunk begins between two classes (8 x the former + the latter).
_BEGINS = np.array([a != _SPACE if b == _SPACE else a in (_LETTER, _DIGIT, _SIGN) and b in (_LETTER, _DIGIT, _SIGN) and (a != b or a == _DIGIT) for a in range(8) for b in range(8)])
#: Two bytes of which some start with a lead but are no such letter: the signs U+00D7 and U+00F7, and U+0130 with two lower letters.
_NO_LETTERS = (0xC397, 0xC3B7, 0xC4B0)

_LOADED: dict[str, "ChunkTokenizer"] = {}


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkTokenizer:
    """Ids as little-endian unsigned 16-bit bytes (the vocabulary is below 65,536)."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # one model for all three; chunks hold no added tokens
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # the split drops all white space, so the chunks' spaces need not be made alike before it
        self.chunks = Tokenizer(self.tokenizer.model)
        self.chunks.pre_tokenizer = self.tokenizer.pre_tokenizer
        self.chunks.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.ends = np.zeros(1 << 16, bool)
        if suffix := self.tokenizer.model.end_of_word_suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.added = [t.content.encode().translate(_PLAIN) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.separator = self.tokenizer.encode(_SEPARATOR, add_special_tokens=False).ids
        if self.tokenizer.get_vocab_size() > 65_536:
            raise ValueError("the vocabulary needs more than 16 bits an id")
        self.seen: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, text: str | bytes | None) -> np.ndarray:
        """Ids of the text (a string or its UTF-8 bytes), then the end id; a null text counts as empty."""
        data = text.encode("utf-8", "replace") if isinstance(text, str) else text
        return next(self.encode_all(pa.array([data], pa.large_binary())))

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text (strings or their UTF-8 bytes), then the end id; a null text counts as empty."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        _, ends, data = texts.buffers()
        ends, data = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1], memoryview(data or b"")
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + GROUP_BYTES, "right")) - 1)
            yield from self._encode_group(bytes(data[ends[at] : ends[to]]), ends[at : to + 1] - ends[at])
            at = to

    def _encode_group(self, data: bytes, ends: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of the texts that stand between ``ends``."""
        low, end = data.translate(_PLAIN), END_ID.to_bytes(2, "little")
        odd = any(a in low for a in self.added) or b"\xcc" in low and _COMPOSED_WHEN_LOWERED(data)
        places, ids = [0] * len(ends), b""
        if low:
            kinds = _kinds(low, ends)
            begins = np.empty(len(low), bool)
            _BEGINS.take(kinds[:-1] * 8 + kinds[1:], out=begins[1:])
            begins[ends[ends < len(low)]] = True
            starts = np.flatnonzero(begins)
            offsets = np.append(starts, len(low))
            chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(low)]).dictionary_encode()
            names = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
            found = list(map(self.seen.get, names))
            if None in found:
                self._learn(names, found)
            _, places, ids = pa.array(found, pa.large_binary()).take(chunks.indices).buffers()
            places, ids = np.frombuffer(places, np.int64)[np.searchsorted(starts, ends)].tolist(), memoryview(ids)
        for i, (a, b) in enumerate(zip(places, places[1:])):
            if odd and self._whole(data[ends[i] : ends[i + 1]], low[ends[i] : ends[i + 1]]):
                yield np.array([*self.tokenizer.encode(data[ends[i] : ends[i + 1]].decode("utf-8", "replace"), add_special_tokens=False).ids, END_ID], "<u2")
            else:
                yield np.frombuffer(b"".join((ids[a:b], end)), "<u2")

    def _whole(self, data: bytes, low: bytes) -> bool:
        """Whether the library has to get the text whole."""
        return any(a in low for a in self.added) or b"\xcc" in low and _COMPOSED_WHEN_LOWERED(data) is not None

    def _learn(self, names: list[bytes], found: list[bytes | None]) -> None:
        """Fill in the ids of those chunks that lack them."""
        if len(self.seen) > KEPT_CHUNKS:
            self.older, self.seen = self.seen, {}
        seen, older = self.seen, self.older
        fresh = []
        for i in [i for i, f in enumerate(found) if f is None]:
            if (ids := older.get(names[i])) is None:
                fresh.append(i)
            else:
                seen[names[i]] = found[i] = ids
        if not fresh:
            return
        chunks = [names[i] for i in fresh]
        ends = np.cumsum([0, *map(len, chunks)])
        # white space alone has no ids, letters alone are a word
        most = np.maximum.reduceat(_kinds(b"".join(chunks), ends), ends[:-1]).tolist()
        words = [c for c, m in zip(chunks, most) if m == _LETTER]
        others = [c for c, m in zip(chunks, most) if m > _LETTER]
        got = dict(zip(words, self._ids_of_words(words)))
        got.update(zip(others, self._ids_of([c.lstrip() for c in others])))
        for i, c in zip(fresh, chunks):
            seen[c] = found[i] = got.get(c, b"")

    def _ids_of_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word of Latin letters; white space may stand before it."""
        if not words:
            return []
        joined = b" ".join(words)
        if not joined.isascii():
            joined = joined.decode().lower().encode()
        ids = np.array(self.words.encode_batch_fast([codecs.charmap_decode(joined, "strict", _SPELLING)[0]], add_special_tokens=False)[0].ids, "<u2")
        ends = ((np.flatnonzero(self.ends[ids]) + 1) * 2).tolist()
        if len(ends) != len(words):
            return self._ids_of(words)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _ids_of(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of each chunk."""
        words = [c.decode("utf-8", "replace") for c in chunks]
        if words and len(self.separator) == 1:
            ids = np.array(self.chunks.encode_batch_fast([f" {_SEPARATOR} ".join(words)], add_special_tokens=False)[0].ids, "<u2")
            ends = np.flatnonzero(ids == self.separator[0]) * 2
            if len(ends) == len(words) - 1:
                data, ends = ids.tobytes(), [*ends.tolist(), 2 * len(ids)]
                return [data[a:b] for a, b in zip([0, *(e + 2 for e in ends)], ends)]
        return [array("H", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def _kinds(low: bytes, ends: np.ndarray) -> np.ndarray:
    """The class of each byte of texts that stand between ``ends``."""
    data, kinds = np.frombuffer(low, np.uint8), np.frombuffer(bytearray(low.translate(_CLASSES)), np.uint8)
    leads = np.flatnonzero(kinds == _LEAD)
    if len(leads):
        kinds[leads] = _GLUE
        leads = leads[leads < len(data) - 1]
        second = data[leads + 1]
        pair = data[leads].astype(np.uint16) << 8 | second
        leads = leads[(second & 0xC0 == 0x80) & (pair != _NO_LETTERS[0]) & (pair != _NO_LETTERS[1]) & (pair != _NO_LETTERS[2])]
        kinds[leads] = kinds[leads + 1] = _LETTER
        # bytes that are no UTF-8 may stand where two texts meet
        cut = ends[(ends > 0) & (ends < len(data))]
        cut = cut[data[cut] & 0xC0 == 0x80]
        kinds[cut] = kinds[cut - 1] = _GLUE
    return kinds


def tokenizer(path: str | None = None) -> ChunkTokenizer:
    """The worker's tokenizer, loaded once."""
    path = path or word_bpe_path()
    if path not in _LOADED:
        _LOADED[path] = ChunkTokenizer(path)
    return _LOADED[path]
