"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

The public vocabulary file gives its pieces' ranks (0, -1, -2, ... as it was merged), not probabilities, and
tokenizers are not trained here. So a piece's log score follows from its rank by the Zipf-Mandelbrot law, P(rank r)
in proportion to 1 / (r + 2.7); a model file that gives log scores of its own is taken as it is. A rare piece costs
more than a common one, but one long piece less than the several short ones it is made of.

Normalisation is the whitespace marker alone: one marker before the text, and one for each space. A segment
runs from a group of markers to the next one, or to a character that no piece holds; no piece crosses such a
border, so the best path of a text is that of its segments in a row, and a worker keeps the segments it has
seen (a bounded number). Where no piece covers a character, the path pays the least score less 10, and the
character is spelt in byte pieces. Equal scores go to the longer last piece. Decoding joins the pieces, turns
byte pieces to bytes and markers to spaces, and drops the first space.

Nulls and empty texts have no ids and decode to the empty text. A marker character that stood in the text is
decoded as a space, so only such texts fail the round trip. A null doc_id is kept. Repeated rows are encoded each;
extra columns are ignored. Very long texts are encoded whole, segment by segment. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
ZIPF_SHIFT = 2.7
#: Segments a worker keeps before it starts anew.
KEPT_SEGMENTS = 1_000_000
SCHEMA = "doc_id long, n_tokens long, ids_crc32 long, n_byte_pieces long, round_trip boolean"


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def zipf_scores(ranks: np.ndarray) -> np.ndarray:
    """Log probabilities of pieces by rank (0 first)."""
    weight = 1.0 / (np.asarray(ranks, np.float64) + 1 + ZIPF_SHIFT)
    return np.log(weight / weight.sum())


def load_pieces(path: str) -> tuple[list[tuple[str, int, float]], dict[int, int], int]:
    """(piece, id, log score) of ordinary pieces, byte -> id, and the unknown id of a model file."""
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    ordinary, bytes_ = [], {}
    for i in range(m.get_piece_size()):
        if m.is_byte(i):
            bytes_[int(m.id_to_piece(i)[1:-1], 16)] = i
        elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
            ordinary.append((m.id_to_piece(i), i, m.get_score(i)))
    scores = [s for *_, s in ordinary]
    if scores and all(s == int(s) for s in scores):
        order = sorted(range(len(ordinary)), key=lambda j: (-scores[j], ordinary[j][1]))
        score = dict(zip(order, zipf_scores(np.arange(len(order))).tolist()))
        ordinary = [(p, i, score[j]) for j, (p, i, _) in enumerate(ordinary)]
    return ordinary, bytes_, m.unk_id()


class DoubleArray:
    """base/check arrays over UTF-8 bytes: from state s, byte b leads to t = base[s] + b if check[t] = s; value[t] holds the id of a word that ends there, or -1."""

    def __init__(self, words: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for w in sorted(words):
            s = 0
            for b in w:
                t = children[s].get(b)
                if t is None:
                    t = children[s][b] = len(children)
                    children.append({})
                    ends.append(-1)
                s = t
            ends[s] = words[w]
        size = 2 * len(children) + 1024
        self.base, self.check, self.value = [0] * size, [-1] * size, [-1] * size
        self.check[0] = 0
        free = cursor = 256  # every label fits below
        queue = [(0, 0)]
        for node, at in queue:
            self.value[at] = ends[node]
            if not children[node]:
                self.base[at] = -1
                continue
            labels = sorted(children[node])
            while self.check[free] >= 0:
                free += 1
            cursor = max(cursor, free)
            base = max(1, (free if len(labels) == 1 else cursor) - labels[0])
            tried = 0
            while True:
                if base + 257 >= len(self.check):
                    grow = len(self.check)
                    self.base += [0] * grow
                    self.check += [-1] * grow
                    self.value += [-1] * grow
                if all(self.check[base + b] < 0 for b in labels):
                    break
                base += 1
                tried += 1
            if tried > 64:  # the region is dense: families of children start further on, single ones fill its gaps
                cursor += tried // 2
            self.base[at] = base
            for b in labels:
                self.check[base + b] = at
                queue.append((children[node][b], base + b))

    def matches(self, data: bytes, start: int):
        """(end, id) of every word that starts there, shortest first."""
        base, check, value, s = self.base, self.check, self.value, 0
        for i in range(start, len(data)):
            b = base[s]
            if b < 0:
                return
            t = b + data[i]
            if t >= len(check) or check[t] != s:
                return
            s = t
            if value[s] >= 0:
                yield i + 1, value[s]


class PieceModel:
    def __init__(self, ordinary: list[tuple[str, int, float]], byte_ids: dict[int, int], unknown_id: int):
        self.trie = DoubleArray({p.encode(): i for p, i, _ in ordinary})
        self.score = {i: s for _, i, s in ordinary}
        self.unknown = min(self.score.values(), default=0.0) - UNKNOWN_PENALTY
        self.byte_ids, self.unknown_id = byte_ids, unknown_id
        held = {c for p, _, _ in ordinary for c in p}
        if any(MARKER in p.lstrip(MARKER) for p, _, _ in ordinary) or "\n" in held:
            raise ValueError("a piece crosses a segment's border")
        self.plain = re.compile(f"\n|{MARKER}*[^{MARKER}\n]+|{MARKER}+")
        self.text = {i: p.replace(MARKER, " ").encode() for p, i, _ in ordinary} | {i: bytes([b]) for b, i in byte_ids.items()} | {unknown_id: b" \xe2\x81\x87 "}
        self.is_byte = np.zeros(max([*self.text, 0]) + 1, bool)
        self.is_byte[list(byte_ids.values())] = True
        self.seen: dict[str, bytes] = {}

    def viterbi(self, segment: str) -> list[int]:
        """The ids of the best path."""
        data = segment.encode("utf-8", "replace")
        n = len(data)
        best, came, by = [float("-inf")] * (n + 1), [-1] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        score, matches = self.score, self.trie.matches
        at = 0
        for c in segment:
            here, width = best[at], len(c.encode("utf-8", "replace"))
            single = False
            for end, i in matches(data, at):
                s = here + score[i]
                single |= end == at + width
                if came[end] < 0 or s > best[end]:
                    best[end], came[end], by[end] = s, at, i
            end = at + width
            if not single and (came[end] < 0 or here + self.unknown > best[end]):
                best[end], came[end], by[end] = here + self.unknown, at, -1
            at = end
        ids: list[int] = []
        while n > 0:
            start = came[n]
            if by[n] >= 0:
                ids.append(by[n])
            elif self.byte_ids:
                ids.extend(self.byte_ids[b] for b in reversed(data[start:n]))
            else:
                ids.append(self.unknown_id)
            n = start
        return ids[::-1]

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        seen = self.seen
        segments = self.plain.findall(MARKER + text.replace(" ", MARKER))
        try:
            return np.frombuffer(b"".join(map(seen.__getitem__, segments)), "<i4")
        except KeyError:
            if len(seen) + len(segments) > KEPT_SEGMENTS:
                seen.clear()
            for s in segments:
                if s not in seen:
                    seen[s] = np.array(self.viterbi(s), "<i4").tobytes()
            return np.frombuffer(b"".join(map(seen.__getitem__, segments)), "<i4")

    def decode(self, ids) -> str:
        text = b"".join(map(self.text.__getitem__, ids.tolist() if isinstance(ids, np.ndarray) else ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_LOADED: dict[str, PieceModel] = {}


def model(path: str | None = None) -> PieceModel:
    path = path or piece_path()
    if path not in _LOADED:
        _LOADED[path] = PieceModel(*load_pieces(path))
    return _LOADED[path]


def _map(docs: DataFrame, path: str | None, schema: str, row) -> DataFrame:
    ship(docs.sparkSession)

    def run(batches):
        m = model(path)
        kinds = None
        for b in batches:
            rows = [row(m, d.as_py(), t.as_py()) for d, t in zip(b.column(0), b.column(1))]
            kinds = [pa.int64(), pa.list_(pa.int32())] if schema.endswith("array<int>") else [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every whole text."""
    return _map(docs, path, "doc_id long, ids array<int>", lambda m, d, t: (d, m.encode(t)))


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of encoded rows (doc_id, ids)."""
    ship(encoded.sparkSession)

    def run(batches):
        m = model(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m.decode(x.as_py() or []) for x in b.column(1)], pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Token count, checksum of the ids, byte pieces, and whether decoding gives the text back, for every document."""

    def row(m: PieceModel, d, t):
        ids = m.encode(t)
        return d, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), int(m.is_byte[ids].sum()), m.decode(ids) == (t or "")

    return _map(docs, path, SCHEMA, row)
