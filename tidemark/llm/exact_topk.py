"""Exact top-k by inner product of quantised vectors, with pivot-table elimination.

Every component x becomes floor(256 x). For a block of candidates the distances to many pivots are computed
once; for a query, max over pivots of |d(q,p) - d(x,p)| is a lower bound of d(q,x), hence
(|q|^2 + |x|^2 - bound^2)/2 an upper bound of the inner product. Candidates are evaluated in bound order until
the next bound is below the k-th score, so the result is exact. A query meets one block of candidates first; its
k-th score there is the floor that it brings to all other blocks, so that from the first bound on whatever lies
below is left out. Blocks of queries meet blocks of candidates; each pair returns k rows a query at most, and one
window by query keeps the best.

Vectors null, or holding null or non-finite components, take no part; nor do null ids. Only vectors of the same
number of components are compared. A row is a candidate of every query of another id, so repeated rows count each;
a repeated query id is one query for each of its rows' vectors and answered as the best of them. Ties go to the
smaller vec_id. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, ship, shuffle_width

PIVOTS = 32
QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 16_384
STEP = 512


def finite(vector: str) -> "F.Column":
    v = F.col(vector)
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def quantise(vectors: DataFrame) -> DataFrame:
    return (
        vectors.where(F.col("vec_id").isNotNull() & finite("embedding"))
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("v"))
    )


def _dot(rows: np.ndarray, q: np.ndarray, exact_in_double: bool) -> np.ndarray:
    if exact_in_double:
        return (rows @ q).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(r, q)) for r in rows], object)


def block_top(qids, q, xids, x, pivots, k, floors=None, spent: list | None = None) -> list[tuple[int, int, int]]:
    """(query, candidate, score): of each query the k best of a block, exactly, as far as they reach its floor.

    ``spent`` takes (candidates evaluated, candidates) of each query.
    """
    large = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    fits = float(large) ** 2 * max(q.shape[1], 1) < 2**52
    qf, xf, pf = q.astype(np.float64), x.astype(np.float64), pivots.astype(np.float64)
    far = lambda a: np.sqrt(np.maximum((a**2).sum(1)[:, None] - 2 * a @ pf.T + (pf**2).sum(1), 0))
    x_to, q_to, x2, q2 = far(xf), far(qf), (xf**2).sum(1), (qf**2).sum(1)
    slack = 1e-7 * (x2.max(initial=0) + q2.max(initial=0) + (pf**2).sum(1).max(initial=0)) + 1
    out = []
    for i, own in enumerate(qids):
        bound = np.zeros(len(x))
        for p in range(pf.shape[0]):
            np.maximum(bound, np.abs(x_to[:, p] - q_to[i, p]), out=bound)
        upper = (q2[i] + x2 - bound**2) / 2 + slack
        floor = None if floors is None or floors[i] is None or floors[i] != floors[i] else int(floors[i])
        order = np.arange(len(x)) if floor is None else np.flatnonzero(upper >= floor)
        order = order[np.argsort(-upper[order], kind="stable")]
        best: list[tuple] = []
        done = 0
        for s in range(0, len(order), STEP):
            at = order[s : s + STEP]
            if len(best) == k and upper[at[0]] < -best[-1][0]:
                break
            done += len(at)
            scores = _dot(xf[at] if fits else x[at], qf[i] if fits else q[i], fits)
            hit = xids[at] != own
            if floor is not None:
                hit &= scores >= floor
            if len(best) == k:
                hit &= scores >= -best[-1][0]
            scores, ids = scores[hit], xids[at][hit]
            if len(scores) > 4 * k and fits:
                hit = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
                scores, ids = scores[hit], ids[hit]
            best = sorted(best + [(-int(c), int(v)) for c, v in zip(scores, ids)])[:k]
        if spent is not None:
            spent.append((done, len(x)))
        out += [(int(own), v, -c) for c, v in best]
    return out


def search(vectors: DataFrame, k: int = 5, every: int = 50, pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): rows whose id is divisible by ``every`` against all others."""
    spark = vectors.sparkSession
    ship(spark)
    rows = quantise(vectors).withColumn("dim", F.size("v"))
    n, asked = rows.agg(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    width = shuffle_width(spark)
    c_blocks = max(1, -(-n // CANDIDATE_BLOCK), min(width, -(-n // 1024)))
    q_blocks = max(1, -(-asked // QUERY_BLOCK))
    chosen: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(4 * pivots).collect():
        chosen.setdefault(r.dim, []).append(r.v)
    # rows that repeat an id are dealt by their vectors too
    deal = F.xxhash64("vec_id", "v")
    candidates = rows.withColumn("cb", F.pmod(deal, F.lit(c_blocks)).cast("int"))
    queries = rows.where(F.col("vec_id") % every == 0).withColumn("qb", F.pmod(deal, F.lit(q_blocks)).cast("int")).withColumn("home", F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(c_blocks)).cast("int"))

    def run(key: tuple, q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        xv = np.stack(x.v.to_list()).reshape(len(x), -1)
        pv = np.array(chosen[key[0]][:pivots]).reshape(-1, xv.shape[1]) if key[0] in chosen else xv[:1]
        found = block_top(q.vec_id.to_numpy(), np.stack(q.v.to_list()).reshape(len(q), -1), x.vec_id.to_numpy(), xv, pv, k, q["floor"].tolist())
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    by = ["dim", "qb", "cb"]

    def meet(asking: DataFrame) -> DataFrame:
        asking = asking.select("vec_id", "v", "dim", "qb", "cb", "floor")
        asking = asking.toDF(*asking.columns)  # attributes of its own
        beside = candidates.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        return asking.groupBy(*by).cogroup(beside.groupBy(*by)).applyInPandas(run, "query_id long, vec_id long, score long")

    near = cut(meet(queries.withColumn("cb", F.col("home")).withColumn("floor", F.lit(None).cast("long"))))
    if c_blocks == 1:
        best = near
    else:
        floors = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        others = F.explode(F.filter(F.sequence(F.lit(0), F.lit(c_blocks - 1)), lambda b: b != F.col("home")))
        best = near.unionByName(meet(queries.join(floors, "vec_id", "left").withColumn("cb", others)))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
