"""The training-data operators against brute force, round trips and their edge cases."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import embedding_dedup, exact_topk, license_scan, line_dedup, near_dup, packing, quality, sentence_pieces, substring_dedup, tokens, training_order

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _rid string"
PROSE = " ".join(f"word{i * i % 97}x{i}" for i in range(120))
TEXTS = [
    None, "", " ", PROSE, PROSE, PROSE.replace("word16x4", "other"), "a b c d e f g\nsecond line", "a b c X e f g\na b c d e f g h", "tail " + PROSE[:260] + " é ü 日本", "The " * 300, "De\n" * 200,
]


def docs(spark, texts=TEXTS):
    rows = [(i, t, "en", "s", None if t is None else len(t), "clash") for i, t in enumerate(texts)] + [(None, "no id " + PROSE, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_line_dedup(spark):
    got = {r.doc_id: r for r in line_dedup.digest(docs(spark)).collect()}
    assert got[4].n_removed == 1 and got[5].n_removed == 1 and got[7].n_removed == 2 and got[6].n_removed == 0
    assert got[0].n_lines == 0 and got[2].n_removed == 0 and len(got) == len(TEXTS) + 1
    assert {r.doc_id for r in line_dedup.dedup(docs(spark)).collect()} >= {0, 1, 2, 6}
    assert line_dedup.digest(empty(spark)).count() == 0


def test_line_dedup_keeps_two_edits(spark):
    got = line_dedup.digest(docs(spark, ["a b c d e f g h", "a b X d e Y g h", "b a c d e f g h"])).collect()
    assert not any(r.n_removed for r in got)


def test_quality(spark):
    good, bad = [f"plain words here number {i} and some more" for i in range(60)], [f"#### $$$ {i} !!!! %%%% &&&&" for i in range(60)]
    d = docs(spark, good + bad + [None, ""])
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.score(d, labels).collect()}
    assert len(got) == 123 and all(0 <= r.score <= 1 for r in got.values())
    out = [(r.predicted == int(i < 60)) for i, r in got.items() if i is not None and i < 120 and r.held_out]
    assert sum(out) >= 0.9 * len(out)
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(120))
    assert quality.score(d, labels.limit(0)).where("score <> 0.5").count() == 0
    assert quality.keep(d, labels).columns == d.columns and quality.score(empty(spark), labels).count() == 0


def test_factorisation_machine_identity():
    m = quality.FactorisationMachine(50, 4)
    x, v = np.array([3, 7, 20]), np.array([1.0, 0.5, 2.0])
    pairs = sum(m.factor[x[i]] @ m.factor[x[j]] * v[i] * v[j] for i in range(3) for j in range(i))
    assert m.logit(x, v) == pytest.approx(m.bias + m.linear[x] @ v + pairs, rel=1e-5)


def test_tokens():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.word_bpe_path())
    for x in [*TEXTS, "a., b), c.' d's. 'S. x'., ΑΣ, Σ. é. İ.\x1cb 12. 3.4, ...", "Å. don't, <|endoftext|>", "a!! é!! ×!! ÷.. É?! x'' x'!? b$$$ c.### d*** e\u0301!! 5%% «f».. g—.. h_ i`", "<|startoftext|>a<|EndOfText|> b.<|endoftext|>", "<|ENDOFTEXT|> A", "fresh1 fresh2 \x01 fresh3\x01 x\x01y", "\x01", "fresh4 \u0301fresh5 \u0308 \u0327c"]:
        assert tokens.tokenizer().encode(x).tolist() == t.encode(x or "", add_special_tokens=False).ids + [1]


def test_packing(spark):
    d = docs(spark, TEXTS + [PROSE * 20])
    rows = packing.pack(d).collect()
    ids = {i: tokens.tokenizer().encode(t) for i, t in enumerate(TEXTS + [PROSE * 20])}
    fill = Counter()
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill[r.sequence_id]
        fill[r.sequence_id] += r.length
        if r.doc_id is not None:
            assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].astype("<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    assert all(n <= 2048 and (n == 2048 or n & (n - 1) == 0) for n in fill.values())
    assert sum(r.length for r in rows if r.doc_id == len(TEXTS)) == len(ids[len(TEXTS)])
    assert packing.pack(empty(spark)).count() == 0


def test_license_scan(spark):
    mit = license_scan.TEMPLATES["mit"]
    d = docs(spark, [PROSE + "\nReleased under the MIT License.", mit.upper(), mit[:200], None, ""])
    assert {(r.doc_id, r.template) for r in license_scan.scan(d).collect()} == {(0, "mit-line"), (1, "mit")}
    assert license_scan.scan(empty(spark)).count() == 0


def _vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(60, 16)).astype(np.float32)
    near = base[:20] + rng.normal(scale=0.01, size=(20, 16)).astype(np.float32)
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(np.concatenate((base, near)))] + [(90, base[0].tolist(), 0), (91, None, 0), (92, [0.0] * 16, 0), (93, [float("nan")] * 16, 0), (94, base[0].tolist(), None), (None, base[0].tolist(), 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_embedding_dedup(spark):
    rows, df = _vectors(spark)
    good = [(i, np.array(v, float), lab) for i, v, lab in rows if i is not None and i <= 90]
    links = {i: {j for j, w, m in good if j != i and m == lab and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98} for i, v, lab in good}
    got = {r.vec_id: r for r in embedding_dedup.link(df).collect()}
    assert all(got[i].n_links == len(links[i]) for i in links) and got[90].component_id == 0 and got[91].kept and got[94].n_links == 0 and len(got) == len(rows)
    assert embedding_dedup.link(df.limit(0)).count() == 0


def test_embedding_recall_in_wide_spaces(spark):
    rng = np.random.default_rng(8)
    for width in (64, 256):
        base = rng.normal(size=(400, width)) + 3 * rng.normal(size=(5, width))[rng.integers(0, 5, 400)]
        unit = base / np.linalg.norm(base, axis=1)[:, None]
        near = embedding_dedup.planted(unit, 0.981, seed=3)
        every = np.concatenate((unit, near))
        df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(every)], "vec_id int, embedding array<double>, label int")
        got = {r.vec_id: r.n_links for r in embedding_dedup.link(df).collect()}
        want = (every @ every.T >= 0.98).sum(1) - 1
        assert sum(got.values()) >= 0.95 * want.sum() and all(got[i] <= want[i] for i in got)


def test_exact_topk_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "CANDIDATE_BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(100)]
    rows += [rows[3], rows[3], rows[50], (200, rows[3][1]), (7, rows[8][1])]
    v = [(i, np.floor(np.array(x) * 256).astype(int)) for i, x in rows]
    got = {}
    for r in exact_topk.search(spark.createDataFrame(rows, "vec_id int, embedding array<double>")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in (0, 200):
        want = sorted((-int(w @ dict(v)[q]), i) for i, w in v if i != q)[:5]
        assert sorted(got[q]) == [(k, i, -s) for k, (s, i) in enumerate(want, 1)]
    assert len(got[50]) == 5


def test_exact_topk_eliminates():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 8)) * 3000
    x = (centres[rng.integers(0, 20, 8000)] + rng.normal(size=(8000, 8)) * 100).astype(int)
    spent: list = []
    exact_topk.block_top(np.arange(50), x[:50], np.arange(8000), x, x[::250], 5, spent=spent)
    assert sum(a for a, _ in spent) < 0.7 * sum(b for _, b in spent)


def test_exact_topk(spark):
    rows, df = _vectors(spark)
    good = {i: [int(np.floor(float(x) * 256)) for x in v] for i, v, _ in rows if i is not None and v is not None and v[0] == v[0]}
    want = {(q, r, i, -s) for q in good if q % 50 == 0 for r, (s, i) in enumerate(sorted((-sum(a * b for a, b in zip(good[q], good[i])), i) for i in good if i != q)[:5], 1)}
    assert {tuple(r) for r in exact_topk.search(df).collect()} == want
    assert exact_topk.search(df.limit(0)).count() == 0


def test_training_order(spark, tmp_path):
    for n in (1, 2, 5, 100, 1000):
        assert sorted(training_order.feistel(np.arange(n), n, 7)) == list(range(n))
    d = docs(spark, TEXTS + [PROSE * 30, "\n".join(["newline ids"] * 700)])
    ordered, size = training_order.materialise(d, shard_slots=2)
    rows = sorted(ordered.collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(size)) and [r.shard for r in rows] == [i // 2 for i in range(size)]
    # every id of every document stands in one sequence
    ids = {i: tokens.tokenizer().encode(t) for i, t in enumerate(TEXTS + [PROSE * 30, "\n".join(["newline ids"] * 700)])}
    seen = Counter()
    for r in rows:
        at = 0
        for doc, start, n in zip(r.doc_ids, r.starts, r.lengths):
            if doc is not None:
                assert bytes(r.ids)[2 * at : 2 * (at + n)] == ids[doc][start : start + n].tobytes()
                seen.update((doc, start + i) for i in range(n))
            at += n
    assert set(seen.values()) == {1} and len(seen) == sum(map(len, ids.values()))
    folder = f"{tmp_path}/shards"
    each = training_order.write_shards(ordered, size, folder, shard_slots=2)
    back = sorted(training_order.read_slots(spark, folder, each, shard_slots=2).collect(), key=lambda r: r.slot)
    assert [(r.slot, r.shard, r.byte_offset, bytes(r.ids)) for r in back] == [(r.slot, r.shard, r.byte_offset, bytes(r.ids)) for r in rows]
    files = sorted(tmp_path.glob("shards/part-*"))
    assert len(files) == -(-size // 2) and sum(f.stat().st_size for f in files) == size * training_order.stride()
    assert training_order.digest(d, shard_slots=2).count() == size and training_order.digest(empty(spark)).count() == 0


def test_sentence_pieces(spark):
    m = sentence_pieces.model()
    pieces = {p: s for p, _, s in sentence_pieces.load_pieces(sentence_pieces.piece_path())[0]}
    rng = np.random.default_rng(5)
    words = ["▁the", "▁unbelievable", "▁naïve", "▁🤖x"] + ["▁" + "".join(rng.choice(list("etaoinshr'é日"), rng.integers(1, 14))) for _ in range(60)]
    for word in words:
        paths = [(0.0, ())]
        for e in range(1, len(word) + 1):
            paths.append(max((paths[s][0] + pieces.get(word[s:e], m.unknown), paths[s][1] + (word[s:e],)) for s in range(e) if word[s:e] in pieces or e == s + 1))
        ids = m.viterbi(word)
        assert sum(m.score.get(i, 0) for i in ids) + m.unknown * sum(c not in pieces for c in paths[-1][1]) == pytest.approx(paths[-1][0])
    assert sum(np.exp(list(pieces.values()))) == pytest.approx(1) and len(m.encode("The unbelievable quick brown foxes jumped")) <= 12
    got = {r.doc_id: r for r in sentence_pieces.digest(docs(spark)).collect()}
    assert all(r.round_trip for r in got.values()) and got[0].n_tokens == 0
    assert {r.doc_id: r.text for r in sentence_pieces.decode(sentence_pieces.encode(docs(spark))).collect()}[8] == TEXTS[8]
    assert sentence_pieces.digest(empty(spark)).count() == 0


def _covered(texts, n=200):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + n] for b in data for i in range(len(b) - n + 1))
    out = []
    for b in data:
        gone = set()
        for i in range(len(b) - n + 1):
            if count[b[i : i + n]] > 1:
                gone.update(range(i, i + n))
        left = bytes(x for i, x in enumerate(b) if i not in gone)
        out.append((len(b), len(gone), sum(i in gone and i - 1 not in gone for i in range(len(b))), hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("block", [2048, 2])
def test_substring_dedup(spark, monkeypatch, block):
    monkeypatch.setattr(substring_dedup, "BLOCK", block)
    shared = PROSE[:230]
    texts = TEXTS + [f"lead {i} {shared} {i * 7919} rest{i}" for i in range(8)] + ["The " * 100 + "x", "abc" * 150]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i in range(len(texts))] == _covered(texts)
    assert substring_dedup.digest(empty(spark)).count() == 0
    assert substring_dedup.remove(docs(spark)).columns == docs(spark).columns


def test_substring_dedup_of_frequent_passages(spark, monkeypatch):
    """Members of frequent grams make a few rows each, not one a window, and what they cover is exact."""
    monkeypatch.setattr(substring_dedup, "BLOCK", 8)
    rng = np.random.default_rng(11)
    word = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    shared = [word(n) for n in (199, 200, 206, 231, 260)]
    near = [word(12) for _ in range(3)]
    texts = [word(int(rng.integers(0, 40))) + near[i % 3][i % 5 :] + shared[i % 5] + near[i % 2][: i % 7] + word(int(rng.integers(0, 40))) for i in range(150)]
    texts += [shared[4], shared[3] * 2, shared[2] + "x", "q" + shared[1], *[shared[4] + word(300) for _ in range(20)]]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.digest(df).collect()}
    assert [got[i] for i in range(len(texts))] == _covered(texts)
    every = substring_dedup.spans(substring_dedup._keyed(df))
    anchored = sum(len(substring_dedup.anchors(np.frombuffer(t.encode(), np.uint8))[0]) for t in texts)
    assert every.count() <= 5 * anchored


def test_packing_gets_few_texts_at_once(spark, monkeypatch):
    """Texts reach the tokenizer in small batches, and the setting is as before then."""
    key, rows, staged = "spark.sql.execution.arrow.maxRecordsPerBatch", [], packing.Staged
    before = spark.conf.get(key)
    monkeypatch.setattr(packing, "Staged", lambda *a: rows.append(int(spark.conf.get(key))) or staged(*a))
    packing.windows_of(docs(spark), 64, None, False)
    assert rows and max(rows) <= 1000 < int(before) and spark.conf.get(key) == before


def test_words_of_latin_letters_skip_the_rules(monkeypatch):
    """Only odd chunks go through the rules before the model, and all ids are the library's."""
    t = tokens.ChunkTokenizer(tokens.word_bpe_path())
    library = lambda w: [*t.tokenizer.encode(w, add_special_tokens=False).ids, tokens.END_ID]
    letters = [chr(c) for c in range(0xC0, 0x180) if c not in (0xD7, 0xF7, 0x130)]
    plain = [f"{a}{c}x{c}{a}" for a in ("", "Q") for c in letters]
    odd = ["\u0130x", "J\u030c", "T\u0323\u0308.", "\u00e9'S", "\u00e9t\u00e9...'ll", "a\u00d7b", "\u0175\u0301!", "\u03a3\u03a3", "1,5.", "\u00bd\u00aa", "e\u0301***"]
    text = " ".join([*plain, *[w + s for w in plain for s in ("***", ".", "&&&")], *odd])
    assert list(t.encode(text)) == library(text)
    assert all(list(t.encode(w)) == library(w) for w in odd)
    asked, ids_of = [], tokens.ChunkTokenizer._ids_of
    monkeypatch.setattr(tokens.ChunkTokenizer, "_ids_of", lambda self, chunks: asked.extend(chunks) or ids_of(self, chunks))
    t = tokens.ChunkTokenizer(tokens.word_bpe_path())
    t.encode(" ".join([*plain, *[w + "***" for w in plain]]))
    assert asked == [b"***"]


def test_tokens_are_looked_up_once_a_distinct_chunk(monkeypatch):
    """Numbers are digits and signs stand apart from words, so few chunks are looked up and kept; ids of many texts at once are the library's."""
    monkeypatch.setattr(tokens, "GROUP_BYTES", 400, raising=False)
    t = tokens.ChunkTokenizer(tokens.word_bpe_path())
    library = lambda w: [*t.tokenizer.encode((w or b"").decode("utf-8", "replace"), add_special_tokens=False).ids, tokens.END_ID]

    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

    t.seen = Counted()
    text = " ".join(f"Wort {i} \u00e9t\u00e9, (wort{i}) {i * i}.{i}%" for i in range(300)).encode()
    texts = [text, text[:500], None, b"", b"it's <|endoftext|> wort", b"x\xc3", b"\xa9. \xc3\xd7.", "J\u030c. \u2026, \u0391.\u03a3 '-s 1\u0301,\u00bd".encode(), b"\n\t", b" wort\n\n"]
    assert t.encode(text).tolist() == library(text)
    assert Counted.asked <= 60 and len(t.seen) <= 60
    assert [x.tolist() for x in t.encode_all(pa.array([b"q", *texts], pa.binary()).slice(1))] == [library(x) for x in texts]
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 3)
    assert [x.tolist() for x in t.encode_all(pa.array(texts * 3, pa.large_binary()))] == [library(x) for x in texts * 3]


def test_substring_dedup_splits_frequent_cores_where_members_differ(spark, monkeypatch):
    """Members of a passage make about a row for each of its ends, however many they are, and runs of all lengths are exact."""
    monkeypatch.setattr(substring_dedup, "BLOCK", 8)
    rng = np.random.default_rng(12)
    word = lambda n: "".join(chr(97 + c) for c in rng.integers(0, 26, n))
    passage = word(275)
    texts = [word(180) + passage + word(180) for _ in range(60)]
    made, parted = [], substring_dedup._parted

    def counted(members, *rest):
        out = parted(members, *rest)
        made.append((members.count(), out.count()))
        return out

    monkeypatch.setattr(substring_dedup, "_parted", counted)
    check = lambda texts: [tuple(r)[1:] for r in substring_dedup.digest(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).sort("doc_id").collect()] == _covered(texts)
    assert check(texts)
    assert made and sum(n for _, n in made) <= 2 * made[0][0]
    assert check([word(9) + "-" * int(n) + word(9) for n in rng.integers(150, 320, 60)] + [passage[:n] + "=" * 150 + passage[: 275 - n] for n in range(0, 275, 9)])


def test_deep_shallow():
    rng = np.random.default_rng(3)
    strings = [bytes(rng.integers(97, 99, rng.integers(0, 90)).tolist()) for _ in range(200)] + [b"a" * n for n in range(150)]
    order, lcps = substring_dedup.deep_shallow(strings)
    assert [strings[i] for i in order] == sorted(strings)
    assert all(x == substring_dedup.common(strings[order[j - 1]], strings[order[j]]) for j, x in enumerate(lcps) if j)


def test_near_dup(spark):
    other = " ".join(f"thing{i}" for i in range(80))
    texts = TEXTS + [other, other.replace("thing40", "z"), " ".join(f"thing{i}" for i in range(40))]
    got = {r.doc_id: r.class_id for r in near_dup.classes(docs(spark, texts)).collect()}
    n = len(TEXTS)
    assert got[3] == got[4] == got[5] == 3 and got[n] == got[n + 1] == n and got[n + 2] == n + 2 and got[0] == 0 and got[2] == 2
    assert {r.doc_id for r in near_dup.keep(docs(spark, texts)).collect()} == {None, *(i for i, c in got.items() if i == c)}
    assert near_dup.classes(empty(spark)).count() == 0


def _near_classes(texts, least=0.8, width=5):
    """All pairs: the smallest index that links of set Jaccard lead to."""
    words = [t.lower().split() for t in texts]
    sets = [{tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, 1))} for w in words]
    root = list(range(len(texts)))
    for j in range(len(texts)):
        for i in range(j):
            if len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
    return root


def test_near_dup_ignores_repeat_counts(spark):
    texts = []
    for k in range(12):
        body, foot = " ".join(f"w{k}x{i}" for i in range(200)), " ".join(f"foot{k}x{i}" for i in range(12))
        texts += [body + f"\n{foot}" * r for r in (2, 20, 40, 80)]
        texts += [body.replace(f"w{k}x{90 + k} ", "new ") + f"\n{foot}" * 60, " ".join(body.split()[:100]) + f"\n{foot}" * 40]
    got = {r.doc_id: r.class_id for r in near_dup.classes(docs(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == _near_classes(texts)


def test_prob_min_hash_estimates():
    a = np.arange(1, 101, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    s = near_dup.prob_min_hash([a, a[10:], a], [np.ones(100), np.ones(90), np.full(100, 3.0)], 2000)
    assert abs((s[0] == s[1]).mean() - 0.9) < 0.04 and abs((s[0] == s[2]).mean() - 1) < 0.01


def test_pipeline(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs(spark, [t for t in TEXTS if t] * 2).drop("_rid").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert len(pipeline.STAGES) == 5 and pipeline.run(spark, str(tmp_path)).count() > 0


def test_pipeline_keeps_one_of_repeated_rows(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    body = lambda k: " ".join(f"body{k}x{i * i % 89}y{i}" for i in range(90))
    near = body(2).replace("body2x0y0 ", "other ")
    rows = [(1, body(0)), (1, body(0)), (None, body(1)), (None, body(1)), (3, body(2)), (None, near), (4, body(3)), (None, body(3)), (5, body(4)), (6, body(5)), (6, body(5)), (6, body(5))]
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA.replace(", _rid string", "")).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
    texts = sorted(r.text for r in kept.collect())
    assert len(texts) == 6 and all(sum(body(k) in t or (k == 2 and near in t) for t in texts) == 1 for k in range(6))


def test_pipeline_stages_begin_with_little_memory(spark, monkeypatch, tmp_path):
    """Executors collect their garbage before each stage, whose Python workers get few texts at once; the setting is as before then."""
    pipeline = pytest.importorskip("corpus_pipeline")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(key)
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    whole = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    for module, name in ((quality, "keep"), (line_dedup, "dedup"), (near_dup, "keep"), (substring_dedup, "remove"), (packing, "pack")):
        monkeypatch.setattr(module, name, lambda d, *a, **b: seen.append((whole(), int(spark.conf.get(key)))) or d)
    first, df = whole(), docs(spark)
    for _, stage in pipeline.STAGES:
        assert stage(spark, df, str(tmp_path)) is df and spark.conf.get(key) == before
    counts = [first, *(n for n, _ in seen)]
    assert len(seen) == 5 and all(a < b for a, b in zip(counts, counts[1:])) and max(rows for _, rows in seen) <= 1000 < int(before)
