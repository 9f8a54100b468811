"""Latest change per key, upsert/delete split, merge-on-read."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

META = ("_op", "_ts", "_seq")
#: Names of the columns that a change leaves as they were, without sending them.
SAME = "_same"


def dedup_latest(changes: DataFrame, pk: list[str], order: tuple[str, ...] = ("_ts", "_seq")) -> DataFrame:
    """One row a key: the greatest by ``order``. The filter on the rank becomes a group limit before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*pk).orderBy(*[F.desc(c) for c in order]))
    return changes.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedup_max_by(changes: DataFrame, pk: list[str], order: tuple[str, ...] = ("_ts", "_seq")) -> DataFrame:
    """The same by one aggregation; better for narrow rows and many changes a key."""
    rest = [c for c in changes.columns if c not in pk]
    best = changes.groupBy(*pk).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_best"))
    return best.select(*[c if c in pk else F.col(f"_best.{c}").alias(c) for c in changes.columns])


def upserts(latest: DataFrame) -> DataFrame:
    return latest.where(F.col("_op").isin("I", "U")).drop(*META)


def delete_keys(latest: DataFrame, pk: list[str]) -> DataFrame:
    """Keys of every change, inserts too: an upsert replaces what earlier commits hold."""
    return latest.select(*pk)


def split(changes: DataFrame, pk: list[str]) -> tuple[DataFrame, DataFrame]:
    latest = dedup_latest(changes, pk)
    return upserts(latest), delete_keys(latest, pk)


def patched_latest(changes: DataFrame, pk: list[str], current: DataFrame) -> DataFrame:
    """The latest change a key; a column that ``_same`` names has the value of the key's last change that sent it, else of its current row."""
    values = [c for c in changes.columns if c not in (*pk, *META, SAME) and c in current.columns]
    w = Window.partitionBy(*pk).orderBy("_ts", "_seq").rowsBetween(Window.unboundedPreceding, 0)
    sent = lambda c: ~F.coalesce(F.array_contains(SAME, c), F.lit(False))
    known = changes.withColumns({f"_known_{i}": F.last(F.when(sent(c), F.struct(F.col(c).alias("v"))), ignorenulls=True).over(w) for i, c in enumerate(values)})
    latest = dedup_latest(known, pk)
    lacking = F.lit(False)
    for i in range(len(values)):
        lacking = lacking | F.col(f"_known_{i}").isNull()
    before = current.select(*pk, *[F.col(c).alias(f"_old_{i}") for i, c in enumerate(values)])
    # only rows that lack something meet the table
    filled = latest.where(lacking).join(before, pk, "left")
    value = lambda i, old: F.when(F.col(f"_known_{i}").isNotNull(), F.col(f"_known_{i}.v")).otherwise(old)
    columns = lambda old: [value(values.index(c), old(values.index(c))).alias(c) if c in values else F.col(c) for c in changes.columns]
    whole = latest.where(~lacking).select(*columns(lambda i: F.lit(None)))
    return whole.unionByName(filled.select(*columns(lambda i: F.col(f"_old_{i}"))))


def merge_on_read(data: DataFrame, deletes: DataFrame, pk: list[str], seq: str = "_commit") -> DataFrame:
    """Rows that no delete of a later commit hides; both sides carry the commit's number.

    Deletes are first reduced to the latest commit a key, so that each row meets one delete at most.
    """
    last = deletes.groupBy(*pk).agg(F.max(seq).alias("_deleted"))
    d, x = data.alias("d"), last.alias("x")
    same = [F.col(f"d.{c}") == F.col(f"x.{c}") for c in pk]
    return d.join(x, [*same, F.col(f"d.{seq}") < F.col("x._deleted")], "left_anti")


def op_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("_op").agg(F.count("*").alias("n"))
