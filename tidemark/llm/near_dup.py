"""Near-duplicate documents by ProbMinHash over word shingles, banding and verification.

Every distinct shingle of five words is a Poisson process: its arrivals have exponential gaps of its weight's
rate and fall on random registers; a register keeps the element that arrives first. Two texts agree on a register
with the probability Jaccard similarity. All weights are 1, whatever a shingle's count, which makes that the
Jaccard similarity of the shingle sets that links are verified by. A process is followed only while it may still
come first in some register of its text (early termination).

Equal texts are one class first. Bands of registers gather candidates; every member of a band is verified against
its earliest one by the exact Jaccard similarity of the shingle sets, and within bands that are not yet one
component the remaining members of different components are verified in blocks of bounded size inside tasks, so
no link between different texts is lost and no pairs of a group are emitted. Classes are the components of links.

Words are lower-cased runs between white space; a text of fewer than five words is one shingle. Texts that are
null or blank are in no class but their own. A class is named by its smallest doc_id, which is kept; documents
without doc_id are in no class (class_id is null) and kept, unless ``keep`` is asked to class them. Ids may be of
any integer type. Rows that repeat id and text are one document, of which ``keep`` leaves one row; two texts under
one id are two documents, each with a class of its own name or of its copies'. Long texts are taken whole. An empty
table gives no rows; ``keep`` carries extra columns, whatever their names.

Texts leave the scan for verification only if a bounded filter of the candidates' hashes lets them through.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import rolling
from tidemark.llm.common import KeyFilter, components, cut, fingerprint, ship, skewed_lookup, trim

LEAST = 0.8
SHINGLE = 5
BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
#: Members of a band that one task compares with each other.
BLOCK = 256
_CHUNK_BYTES = 1 << 21


def _shingle_hashes(texts: list[str], width: int) -> list[np.ndarray]:
    """The hashes of each text's shingles, in order."""
    coded = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    blank = data <= 32
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    word = rolling.spans(rolling.prefix(data), starts, ends)
    offsets = np.cumsum([0] + [len(c) + 1 for c in coded])
    first = np.searchsorted(starts, offsets)
    out = []
    n = max(len(word) - width + 1, 0)
    with np.errstate(over="ignore"):
        run = np.zeros(n, np.uint64)
        for j in range(width):
            run = rolling.mix(run * np.uint64(0x100000001B3) + word[j : j + n])
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= width:
                out.append(run[a : b - width + 1])
            elif b > a:
                short = np.zeros(1, np.uint64)
                for w in word[a:b]:
                    short = rolling.mix(short * np.uint64(0x100000001B3) + w)
                out.append(short)
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def prob_min_hash(elements: list[np.ndarray], weights: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """Signatures (32 bits of the winning element) of weighted sets; empty sets have zeros only."""
    n = len(elements)
    none = np.uint64(2**64 - 1)
    best = np.full(n * registers, none, np.uint64)
    owner = np.repeat(np.arange(n), [len(e) for e in elements])
    h = rolling.mix(np.concatenate([*elements, np.zeros(0, np.uint64)]))
    rate = np.concatenate([*weights, np.zeros(0)]).astype(np.float64)
    time = np.zeros(len(h))
    step = 0
    with np.errstate(over="ignore"):
        while len(h):
            s = rolling.mix(h + np.uint64((step * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64))
            time = time - np.log(((s >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52) / rate
            register = (rolling.mix(s) % np.uint64(registers)).astype(np.int64)
            bits = time.astype(np.float32).view(np.uint32).astype(np.uint64)
            key = (bits << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
            np.minimum.at(best, owner * registers + register, key)
            last = best.reshape(n, registers).max(1) >> np.uint64(32)
            go = bits <= last[owner]
            h, rate, time, owner = h[go], rate[go], time[go], owner[go]
            step += 1
    best[best == none] = 0
    return (best & np.uint64(0xFFFFFFFF)).reshape(n, registers)


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.zeros((len(signatures), bands), np.uint64)
    with np.errstate(over="ignore"):
        out += np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(rows):
            out = rolling.mix(out * np.uint64(0x100000001B3) + signatures[:, r::rows][:, :bands])
    return out.view(np.int64)


def _chunks(texts):
    """Runs of texts of bounded size (a longer text alone)."""
    at, size = [], 0
    for t in texts:
        at.append(t or "")
        size += len(at[-1])
        if size >= _CHUNK_BYTES:
            yield at
            at, size = [], 0
    if at:
        yield at


def _bands(docs: DataFrame, width: int) -> DataFrame:
    def run(batches):
        for b in batches:
            keys = []
            for texts in _chunks(b.column("text").to_pylist()):
                sets = [np.unique(s) for s in _shingle_hashes(texts, width)]
                keys.append(band_keys(prob_min_hash(sets, [np.ones(len(x)) for x in sets])))
            flat = np.concatenate(keys).reshape(-1) if keys else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("fa"), b.column("fb"), lists], names=["doc_id", "fa", "fb", "bands"])
        trim()

    f = fingerprint("text")
    return docs.select("doc_id", f["a"].alias("fa"), f["b"].alias("fb"), "text").mapInArrow(run, "doc_id long, fa long, fb long, bands array<long>")


def _shingle_sets(texts: DataFrame, width: int) -> DataFrame:
    """(id, fa, held) of (id, fa, text)."""

    def run(batches):
        for b in batches:
            at = 0
            for texts in _chunks(b.column("text").to_pylist()):
                sets = [np.unique(s).view(np.int64) for s in _shingle_hashes(texts, width)]
                yield pa.RecordBatch.from_arrays([b.column("id").slice(at, len(texts)), b.column("fa").slice(at, len(texts)), pa.array(sets, pa.list_(pa.int64()))], names=["id", "fa", "held"])
                at += len(texts)
        trim()

    return texts.mapInArrow(run, "id long, fa long, held array<long>")


def _shared_counts(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """|a & b| of each set with each other one, by places in the sorted values of all ``others``."""
    flat = np.concatenate([*others, np.zeros(0, np.int64)])
    owner = np.repeat(np.arange(len(others)), [len(o) for o in others])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    out = np.zeros((len(sets), len(others)), np.int64)
    for i, s in enumerate(sets):
        lo, hi = np.searchsorted(flat, s, "left"), np.searchsorted(flat, s, "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(s) else np.zeros(0, np.int64)
        out[i] = np.bincount(owner[at], minlength=len(others))
    return out


def _block_links(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links that join different components, among a block's two sides (equal sides: within one)."""
    rows = rows.drop_duplicates(["id", "fa", "side"])
    ids, marks, side = rows.id.to_numpy(), rows.fa.to_numpy(), rows.side.to_numpy()
    sets = [np.asarray(x) for x in rows.held]
    size = np.array([len(s) for s in sets])
    root = pd.factorize(pd.MultiIndex.from_arrays([rows.ri, rows.rf]))[0]
    up = np.arange(len(rows))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if (side == 1).any() else left
    both = _shared_counts([sets[i] for i in left], [sets[j] for j in right])
    linked = both >= least * (size[left][:, None] + size[right][None] - both) - 1e-9
    linked &= root[left][:, None] != root[right][None]
    if right is left:
        linked = np.triu(linked, 1)
    out = []
    for x, y in np.argwhere(linked):
        i, j = left[x], right[y]
        a, b = find(root[i]), find(root[j])
        if a != b:
            up[max(a, b)] = min(a, b)
            out.append((int(ids[i]), int(marks[i]), int(ids[j]), int(marks[j])))
    return pd.DataFrame(out, columns=["ai", "af", "bi", "bf"]).astype("int64")


def _classed(docs: DataFrame, least: float, width: int) -> DataFrame:
    """(doc_id, fa, fb, root) of every document with an id; fa, fb: its text's fingerprint.

    A text's node is (its smallest doc_id, fa), so two texts that share an id stay two; root is the least node of
    the class, and its id the class's name.
    """
    ship(docs.sparkSession)
    f = fingerprint("text")
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    full = docs.where(F.coalesce(F.col("text").rlike(r"\S"), F.lit(False)))
    banded = _bands(full, width)
    texts = cut(banded.groupBy("fa", "fb").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"), F.count("*").alias("n")))
    keyed = texts.select(F.struct("id", "fa").alias("node"), F.explode("bands").alias("band"))
    groups = keyed.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    members = cut(skewed_lookup(keyed, groups.select("band", "n", "first", F.col("n").alias("size")), ["band"], F.xxhash64("node")).select("band", "node", "first", "size"))
    active = cut(members.select(F.xxhash64("node.id", "node.fa").alias("h")).distinct())
    wanted = KeyFilter(active, active.count())
    # texts of candidates alone leave the scan, as shingle sets
    candidates = full.where(wanted.may_hold(F.xxhash64("doc_id", f["a"]))).select(F.col("doc_id").alias("id"), f["a"].alias("fa"), "text")
    sets = cut(_shingle_sets(candidates, width).groupBy(F.struct("id", "fa").alias("node")).agg(F.first("held").alias("held")))
    edges = cut(members.where("node <> first").select("node", "first").distinct())
    pivots = edges.groupBy("first").agg(F.count("*").alias("n")).join(sets.select(F.col("node").alias("first"), F.col("held").alias("other")), "first")
    both = F.size(F.array_intersect("held", "other"))
    pairs = skewed_lookup(edges.join(sets, "node"), pivots, ["first"], F.xxhash64("node"), salts=16)
    near = cut(pairs.withColumn("both", both).where(F.col("both") >= least * (F.size("held") + F.size("other") - F.col("both")) - 1e-9).select(F.col("node").alias("a"), F.col("first").alias("b")))
    roots = components(near)
    tagged = members.where("size > 2").join(roots.select(F.col("id").alias("node"), "root"), "node", "left").select("band", "node", F.coalesce("root", "node").alias("root"))
    mixed = (
        tagged.groupBy("band")
        .agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("which"))
        .where("lo < hi")
        .groupBy("which", "n")
        .agg(F.min("band").alias("band"))
    )
    blocks = F.ceil(F.col("parts") / F.lit(BLOCK)).cast("int")
    left = skewed_lookup(tagged, mixed.select("band", "n", F.col("n").alias("parts")), ["band"], F.xxhash64("node")).withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = left.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "node", F.col("root.id").alias("ri"), F.col("root.fa").alias("rf"), F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), (F.col("own") > F.col("with")).cast("int").alias("side")
    )
    compared = dealt.join(sets, "node").select("band", "i", "j", "side", "node.id", "node.fa", "ri", "rf", "held")
    rest = cut(compared.groupBy("band", "i", "j").applyInPandas(lambda rows: _block_links(rows, least), "ai long, af long, bi long, bf long"))
    if not rest.isEmpty():
        pair = lambda a, b: F.struct(F.col(a).alias("id"), F.col(b).alias("fa"))
        roots = components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(rest.select(pair("ai", "af").alias("a"), pair("bi", "bf").alias("b"))))
    of_text = texts.select("fa", "fb", F.struct("id", "fa").alias("node"), "n").join(roots.withColumnRenamed("id", "node"), "node", "left").select("fa", "fb", F.coalesce("root", "node").alias("root"), "n")
    found = skewed_lookup(full.select("doc_id", f["a"].alias("fa"), f["b"].alias("fb")), of_text, ["fa", "fb"], F.col("doc_id")).select("doc_id", "fa", "fb", "root")
    blank = docs.where(~F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))).select("doc_id", f["a"].alias("fa"), f["b"].alias("fb"), F.struct(F.col("doc_id").alias("id"), f["a"].alias("fa")).alias("root"))
    return found.unionByName(blank)


_IS_ROOT = "doc_id = root.id and fa = root.fa"


def classes(docs: DataFrame, least: float = LEAST, width: int = SHINGLE) -> DataFrame:
    """(doc_id, class_id, kept) of every document; without an id: in no class, and kept."""
    found = _classed(docs, least, width).select("doc_id", F.col("root.id").alias("class_id"), F.expr(_IS_ROOT).alias("kept"))
    lone = docs.where("doc_id is null").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("class_id"), F.lit(True).alias("kept"))
    return found.unionByName(lone)


def keep(docs: DataFrame, least: float = LEAST, width: int = SHINGLE, null_ids: bool = False) -> DataFrame:
    """The documents, one row of each class: of rows that repeat id and text one stays.

    With ``null_ids``, texts without id are in classes too, behind all that have one: they are named by their hash,
    from 2**62 on. Without it only equal ones among them are one. Blank texts without id stay as they are.
    """
    full = F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))
    lone = docs.where(F.col("doc_id").isNull() & ~full)
    docs = docs.where(F.col("doc_id").isNotNull() | full)
    name = F.lit(2**63 - 1) - F.xxhash64("text").bitwiseAND(F.lit(2**62 - 1))
    own = (F.coalesce("doc_id", name) if null_ids else F.col("doc_id")).cast("long")
    f = fingerprint("text")
    classed = _classed(docs.select(own.alias("doc_id"), "text"), least, width)
    gone = classed.where(~F.expr(_IS_ROOT)).select(F.col("doc_id").alias("id"), "fa", "fb").distinct()
    rows = docs.select(own.alias("id"), f["a"].alias("fa"), f["b"].alias("fb"), F.struct("*").alias("row"))
    # both keyed alike, so that the texts are shuffled once
    one = rows.dropDuplicates(["id", "fa", "fb"]).join(gone, ["id", "fa", "fb"], "left_anti")
    return one.select("row.*").unionByName(lone)
