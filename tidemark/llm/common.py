"""What several training-data operators share: shipping, checkpoints, skew-safe joins, components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.staged import Staged, checkpoint_folder, cut  # noqa: F401

_SHIPPED = "_tidemark_shipped"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a context."""
    sc = spark.sparkContext
    if getattr(sc, _SHIPPED, False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    setattr(sc, _SHIPPED, True)


def trim() -> None:
    """Give a Python worker's free memory back, token chunks too: workers serve stage after stage, and what one needed once would stay."""
    import ctypes
    import sys

    import pyarrow

    if tokens := sys.modules.get("tidemark.llm.tokens"):
        tokens._LOADED.clear()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def few_at_once(spark: SparkSession, rows: int = 500):
    """Python workers that start in here get at most so many rows at once: a batch of long texts takes its bytes several times over in the JVM."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def give_back(spark: SparkSession) -> None:
    """Executors collect their garbage and give the heap beyond it back, which they else keep at the most that any step before has taken.

    One small task for each core that is at hand, so each executor that is free gets some; calls at once are one
    collection. Results never depend on it. The driver's Python gives back what it no longer needs, too.
    """
    trim()
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.call_function("java_method", F.lit("java.lang.System"), F.lit("gc"))).collect()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fingerprint(*cols: Column) -> Column:
    """128 bits as a struct of two longs: equal inputs have equal values, and others practically never do."""
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(0x5DEECE66D), *cols).alias("b"))


def salted_lookup(left: DataFrame, right: DataFrame, keys: list[str], by: Column, how: str = "left", salts: int = 32) -> DataFrame:
    """``left`` joined with the unique-keyed, small-rowed ``right``; a key may hold any share of ``left``.

    Rows of ``left`` with one key go to ``salts`` tasks by a hash of ``by``; ``right`` is repeated so often.
    """
    lhs = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    rhs = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return lhs.join(rhs, [*keys, "_salt"], how).drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (a, b) of any orderable ids: rows (id, root), root being the smallest id reached.

    Each round hangs every id and its larger neighbours below the smallest neighbour, and then lets each id
    follow its parent's parent. Both look-ups deal hot ids to several tasks, so neither a hub that a third of all
    ids point to nor an id with many smaller neighbours is gathered in one. Every round is checkpointed; the number
    of rounds grows with the logarithm of the longest chain.
    """
    pairs = cut(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("r"))
        .distinct()
    )
    while True:
        least = pairs.groupBy("v").agg(F.min("r").alias("m"), F.count("*").alias("n"))
        hung = skewed_lookup(pairs, least, ["v"], F.xxhash64("r"))
        small = cut(hung.select(F.explode(F.array("v", "r")).alias("v"), F.col("m").alias("r")).where("v <> r").distinct())
        parent = small.groupBy("v").agg(F.min("r").alias("up")).select(F.col("v").alias("r"), "up")
        children = small.groupBy("r").agg(F.count("*").alias("n"))
        jumped = skewed_lookup(small, children.join(parent, "r"), ["r"], F.xxhash64("v"), "left").select("v", F.coalesce("up", "r").alias("r"), F.col("up").isNotNull().alias("moved"))
        pairs = cut(jumped.groupBy("v", "r").agg(F.max("moved").alias("moved")))
        n, keys, moved = pairs.agg(F.count("*"), F.countDistinct("v"), F.count(F.when(F.col("moved"), 1))).first()
        pairs = pairs.drop("moved")
        if n == keys and not moved:
            return pairs.select(F.col("v").alias("id"), F.col("r").alias("root"))


def skewed_lookup(left: DataFrame, right: DataFrame, keys: list[str], by: Column, how: str = "inner", salts: int = 64) -> DataFrame:
    """``left`` joined with ``right``, whose ``keys`` are unique and whose column ``n`` counts the rows of ``left`` with them.

    Keys with over 1/1024 of those rows (so under 1024 keys, which bounds what the driver gets) are dealt to
    ``salts`` tasks by a hash of ``by``; all others are joined as they are.
    """
    right = cut(right)
    total = right.agg(F.sum("n")).first()[0] or 0
    mark = F.xxhash64(*keys)
    hot = [r[0] for r in right.where(F.col("n") > max(2048, total // 1024)).select(mark).collect()]
    if not hot:
        return left.join(right.drop("n"), keys, how)
    salt = F.when(mark.isin(hot), F.pmod(F.xxhash64(by), F.lit(salts))).otherwise(0).cast("int")
    spread = F.when(mark.isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return left.withColumn("_salt", salt).join(right.withColumn("_salt", F.explode(spread)).drop("n"), [*keys, "_salt"], how).drop("_salt")


#: Bits of a filter for each key, and at most (32 MB); hashes of a key; words in a row of the filter.
_FILTER_BITS, _FILTER_MOST, _FILTER_HASHES, _FILTER_ROW = 16, 1 << 28, 3, 4096


class KeyFilter:
    """A Bloom filter of a column of 64-bit hashes as one row, looked up by a scalar subquery inside a scan.

    It has 16 bits a key and 32 MB at most; beyond some 16 million keys more others pass. It only thins what is
    shuffled to an exact join, so results never depend on it.
    """

    def __init__(self, keys: DataFrame, count: int):
        spark = keys.sparkSession
        self.bits = min(_FILTER_MOST, max(1 << 18, 1 << (max(count, 1) * _FILTER_BITS - 1).bit_length()))
        key = keys.columns[0]
        at = keys.select(F.explode(F.array(*[self._place(F.col(key), i) for i in range(_FILTER_HASHES)])).alias("p"))
        words = at.groupBy(F.expr("p div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, int(p % 64)))").alias("b"))
        every = spark.range(self.bits // 64).withColumnRenamed("id", "w").join(words, "w", "left").select("w", F.coalesce("b", F.lit(0).cast("long")).alias("b"))
        rows = every.groupBy(F.expr(f"w div {_FILTER_ROW}").alias("r")).agg(F.sort_array(F.collect_list(F.struct("w", "b")))["b"].alias("row"))
        self.table = cut(rows.agg(F.sort_array(F.collect_list(F.struct("r", "row")))["row"].alias("bits")))

    def _place(self, key: Column, i: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(i), key), F.lit(self.bits).cast("long"))

    def may_hold(self, key: Column) -> Column:
        held = self.table.scalar()
        out = F.lit(True)
        for i in range(_FILTER_HASHES):
            p = self._place(key, i)
            word = F.get(F.get(held, (p / (64 * _FILTER_ROW)).cast("int")), F.pmod((p / 64).cast("long"), F.lit(_FILTER_ROW)).cast("int"))
            out = out & (F.call_function("shiftright", word, F.pmod(p, F.lit(64)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1)
        return out


def set_aside(docs: DataFrame) -> DataFrame:
    """(doc_id, text, _row): all other columns in one struct, so that no name of theirs can clash."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", (F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None)).alias("_row"))


def put_back(out: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` in order, with the new text and, where there is one, its length as n_chars."""
    new = {"doc_id": F.col("doc_id"), "text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(dict(docs.dtypes)["n_chars"])
    return out.select(*[new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])
