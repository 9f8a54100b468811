"""Embedding near-duplicates over an inverted multi-index.

Independent codebooks on the two halves of the unit vectors (fitted on a bounded sample) form a product grid;
every vector stands in one cell of it, beside its label. A vector visits cells in the order of its distance to
them (multi-sequence: two sorted lists, a heap over the grid) as long as a linked vector may lie there, and
verifies the cosine in double precision. How far it goes is ``reach``: the share of the linking radius by which
a link may cross a cell's border. It is raised, from what random differences need, until three kinds of links are
found to the target recall: those that some sampled vectors have among all rows (a brute-force scan), and planted
ones at exactly the linking cosine, whose differences are random, and point at other vectors; 1 is exhaustive.
Codebooks grow with the fourth root of the number of vectors, so that a cell holds about its square root.

Equal vectors of a label are one class with a count. A cell's vectors are dealt to blocks of bounded size, and
blocks meet blocks, so a cell of any size is spread; pairs are counted inside, never emitted: a block returns
for each vector its count and its root among the links there.

Vectors null, zero, or holding null or non-finite components, and rows without label or id, link with nothing.
Only vectors of the same number of components link. Repeated rows of one vec_id count as vectors of their own.
An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, cut, fingerprint, ship, skewed_lookup
from tidemark.llm.exact_topk import finite

LEAST = 0.98
SAMPLE = 4096
CENTROIDS = (24, 256)
BLOCK = 1024
TARGET_RECALL = 0.99
#: Vectors whose links are looked up among all rows to measure recall, and links of each that a batch returns.
PROBES, PROBE_LINKS = 128, 8


def fit_codebook(rows: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm; fewer centroids where there are fewer distinct rows."""
    rows = np.unique(rows, axis=0)
    k = min(k, len(rows))
    centres = rows[np.random.default_rng(seed).choice(len(rows), k, replace=False)]
    for _ in range(rounds):
        at = ((rows[:, None, :] - centres[None]) ** 2).sum(2).argmin(1) if len(rows) * k < 2e5 else (-2 * rows @ centres.T + (centres**2).sum(1)).argmin(1)
        centres = np.array([rows[at == j].mean(0) if (at == j).any() else centres[j] for j in range(k)])
    return centres


class MultiIndex:
    def __init__(self, books: list[np.ndarray], radius: float, reach: float):
        self.books, self.radius, self.reach = books, radius, reach
        self.gaps = [np.maximum(np.sqrt(np.maximum(((b[:, None] - b[None]) ** 2).sum(2), 0)), 1e-12) for b in books]

    def halves(self, unit: np.ndarray) -> list[np.ndarray]:
        h = unit.shape[1] // 2
        return [unit[:, :h], unit[:, h:]]

    def border(self, unit: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each half: own centroid, and the least distance to every centroid's cell."""
        own, far = [], []
        for x, b, g in zip(self.halves(unit), self.books, self.gaps):
            d = np.maximum((x**2).sum(1)[:, None] - 2 * x @ b.T + (b**2).sum(1), 0)
            at = d.argmin(1)
            own.append(at)
            far.append(np.maximum(d - d[np.arange(len(x)), at][:, None], 0) / (2 * g[at]))
        return own, far

    def cells(self, own: list[np.ndarray]) -> np.ndarray:
        return own[0] * len(self.books[1]) + own[1]

    def visit(self, far0: np.ndarray, far1: np.ndarray) -> list[int]:
        """Cells by rising distance, up to reach x radius (multi-sequence traversal)."""
        limit = (self.reach * self.radius) ** 2 + 1e-9
        a, b = np.argsort(far0, kind="stable"), np.argsort(far1, kind="stable")
        x, y = far0[a] ** 2, far1[b] ** 2
        heap, out = [(x[0] + y[0], 0, 0)], []
        while heap:
            s, i, j = heapq.heappop(heap)
            if s > limit:
                break
            out.append(int(a[i]) * len(self.books[1]) + int(b[j]))
            if j + 1 < len(b):
                heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
        return out


def _units(v, width: int) -> np.ndarray:
    out = np.zeros((len(v), width))
    for i, r in enumerate(v):
        out[i, : len(r)] = r
    return out / np.linalg.norm(out, axis=1)[:, None]


def planted(unit: np.ndarray, least: float, seed: int = 11) -> np.ndarray:
    """For each vector two at cosine ``least``: off it in a random direction, and towards another vector."""
    order = np.random.default_rng(seed)
    side = np.sqrt(max(1 - least**2, 0))
    out = []
    for towards in (order.normal(size=unit.shape), unit[order.permutation(len(unit))] - unit):
        towards = towards - (towards * unit).sum(1)[:, None] * unit
        length = np.linalg.norm(towards, axis=1)[:, None]
        out.append(np.where(length > 1e-12, least * unit + side * towards / np.maximum(length, 1e-12), unit))
    return np.concatenate(out)


def recall(index: MultiIndex, a: np.ndarray, b: np.ndarray) -> float:
    """The share of links a[i], b[i] (unit vectors) that a's visits find."""
    _, far = index.border(a)
    cells = index.cells(index.border(b)[0])
    return float(np.mean([c in index.visit(x, y) for x, y, c in zip(*far, cells)])) if len(a) else 1.0


def build_index(unit: np.ndarray, links: tuple[np.ndarray, np.ndarray], least: float, n: int, target: float = TARGET_RECALL) -> MultiIndex:
    """Codebooks of the sampled unit vectors, and the least reach that finds ``links`` and planted ones to the target."""
    h = unit.shape[1] // 2
    k = int(min(CENTROIDS[1], max(CENTROIDS[0], round(n**0.25))))
    index = MultiIndex([fit_codebook(unit[:, :h], k), fit_codebook(unit[:, h:], k)], float(np.sqrt(max(2 - 2 * least, 0))), 1.0)
    some = unit[:512]
    away = planted(some, least)
    kinds = [(some, away[: len(some)]), (some, away[len(some) :]), links]
    for share in np.linspace(0.4, 0.95, 12):
        index.reach = float(share)
        if min(recall(index, a, b) for a, b in kinds) >= target:
            return index
    index.reach = 1.0
    return index


def _probe_links(classes: DataFrame, probes: list, width: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of the probes among all rows, as unit vectors (probe, other): a bounded number."""
    unit = _units([np.array(p.v) for p in probes], width)
    label = [(p.label, len(p.v)) for p in probes]
    own = [p.rep for p in probes]

    def run(batches):
        for b in batches:
            v = b.column("v").to_pylist()
            near = _units(v, width) @ unit.T >= least
            out, count = [], np.zeros(len(unit), int)
            for i, j in np.argwhere(near):
                if count[j] < PROBE_LINKS and b.column("rep")[i].as_py() != own[j] and (b.column("label")[i].as_py(), len(v[i])) == label[j]:
                    count[j] += 1
                    out.append((int(j), v[i]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.list_(pa.float64()))], names=["probe", "other"])

    found = classes.select("rep", "label", F.col("v").cast("array<double>").alias("v")).mapInArrow(run, "probe long, other array<double>").limit(PROBES * PROBE_LINKS).collect()
    if not found:
        return np.zeros((0, width)), np.zeros((0, width))
    return unit[[r.probe for r in found]], _units([np.array(r.other) for r in found], width)


def _roots(hit: np.ndarray, qids: np.ndarray, xids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each side reaches through the block's links."""
    none = np.iinfo(np.int64).max
    q, x = qids.copy(), xids.copy()
    while True:
        nq = np.minimum(q, np.where(hit, x[None, :], none).min(1))
        nx = np.minimum(x, np.where(hit, nq[:, None], none).min(0))
        if (nq == q).all() and (nx == x).all():
            return q, x
        q, x = nq, nx


def link(vectors: DataFrame, least: float = LEAST, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    spark = vectors.sparkSession
    ship(spark)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite("embedding") & F.exists("embedding", lambda x: x != 0)
    kind = vectors.schema["embedding"].dataType.simpleString()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast(kind if kind in ("array<float>", "array<double>") else "array<double>").alias("embedding"))
    good = rows.where(usable).withColumn("f", fingerprint("label", "embedding"))
    classes = cut(good.groupBy("f", "label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")).select("f", "label", F.col("embedding").alias("v"), "rep", "copies", F.size("embedding").alias("dim")))
    n, wide = classes.agg(F.count("*"), F.max("dim")).first()
    width = max(2, wide or 2)
    chosen = classes.orderBy(F.xxhash64("rep"), "rep", "f").limit(sample).select("rep", "v", "label").collect()
    alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if not chosen:
        return alone
    links = _probe_links(classes, chosen[:PROBES], width, least)
    shared = spark.sparkContext.broadcast(build_index(_units([np.array(r.v) for r in chosen], width), links, least, n))

    def place(batches):
        index = shared.value
        for b in batches:
            own, far = index.border(_units([np.array(v) for v in b.column("v").to_pylist()], width))
            yield pa.RecordBatch.from_arrays(
                [b.column("rep"), b.column("label"), b.column("dim"), b.column("copies"), b.column("v"), pa.array(index.cells(own), pa.int32()), pa.array([index.visit(x, y) for x, y in zip(*far)], pa.list_(pa.int32()))],
                names=["rep", "label", "dim", "copies", "v", "cell", "visits"],
            )

    label_type = dict(classes.dtypes)["label"]
    placed = cut(classes.select("rep", "label", "dim", "copies", "v").mapInArrow(place, f"rep long, label {label_type}, dim int, copies long, v {dict(classes.dtypes)["v"]}, cell int, visits array<int>"))
    key = ["label", "dim", "cell"]
    blocks = placed.groupBy(*key).agg(F.count("*").alias("n"), F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    deal = lambda c: F.pmod(F.xxhash64("rep", F.lit(c)), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    index_side = skewed_lookup(placed.select("rep", "copies", "v", *key), blocks, key, F.xxhash64("rep")).withColumn("xb", deal(1)).withColumn("qb", every).drop("blocks")
    query_side = skewed_lookup(placed.select("rep", "v", "label", "dim", F.explode("visits").alias("cell")), blocks, key, F.xxhash64("rep")).withColumn("qb", deal(2)).withColumn("xb", every).drop("blocks")

    def verify(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"rep": [], "links": [], "root": []}).astype("int64")
        qv, xv = np.stack(q.v.to_list()).astype(np.float64), np.stack(x.v.to_list()).astype(np.float64)
        cosine = (qv @ xv.T) / (np.linalg.norm(qv, axis=1)[:, None] * np.linalg.norm(xv, axis=1)[None])
        qi, xi = q.rep.to_numpy(), x.rep.to_numpy()
        hit = (cosine >= least) & (qi[:, None] != xi[None])
        qr, xr = _roots(hit, qi, xi)
        a, b = hit.any(1), hit.any(0)
        return pd.DataFrame({"rep": np.concatenate((qi[a], xi[b])), "links": np.concatenate(((hit @ x.copies.to_numpy())[a], np.zeros(b.sum(), np.int64))), "root": np.concatenate((qr[a], xr[b]))})

    by = [*key, "qb", "xb"]
    query_side = query_side.toDF(*query_side.columns)  # attributes of its own
    found = cut(query_side.groupBy(*by).cogroup(index_side.groupBy(*by)).applyInPandas(verify, "rep long, links long, root long"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    of_class = (
        classes.select("f", "rep", "copies")
        .join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
        .join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left")
        .select("f", F.col("copies").alias("n"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    )
    linked = skewed_lookup(good.select("vec_id", "f"), of_class, ["f"], F.col("vec_id")).select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    rest = rows.where(~F.coalesce(usable, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    return linked.unionByName(rest)
