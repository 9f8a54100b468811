"""Transactions, ordering and batching of raw changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def committed(changes: DataFrame, commits: DataFrame) -> DataFrame:
    """Changes of committed transactions, with their commit's position and time."""
    return changes.join(commits.select("xid", "commit_lsn", "commit_ts"), "xid")


def drop_aborted(changes: DataFrame, aborts: DataFrame) -> DataFrame:
    """Changes without those of aborted transactions, or of aborted subtransactions alone."""
    whole = aborts.where(F.col("subxid").isin(0) | (F.col("subxid") == F.col("xid"))).select("xid").distinct()
    part = aborts.select("xid", "subxid").distinct()
    return changes.join(whole, "xid", "left_anti").join(part, ["xid", "subxid"], "left_anti")


def assign_sequence(changes: DataFrame, start: int, order: list[str], buckets: str | None = None) -> DataFrame:
    """Monotone ``_seq`` in commit order without a global window: counts before each bucket (a coarse prefix of the order) are added to ranks within it."""
    if buckets is None:
        return changes.withColumn("_seq", F.lit(start) + F.row_number().over(Window.orderBy(*order)) - 1)
    counts = changes.groupBy(buckets).agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy(buckets).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    rank = F.row_number().over(Window.partitionBy(buckets).orderBy(*order))
    return changes.join(before, buckets).withColumn("_seq", F.lit(start) + F.col("_before") + rank - 1).drop("_before")


def expand_updates(changes: DataFrame, old_key: str, pk: str) -> DataFrame:
    """An update that names another old key becomes a delete of that key and the update."""
    moved = (F.col("_op") == "U") & F.col(old_key).isNotNull() & (F.col(old_key) != F.col(pk))
    rest = [c for c in changes.columns if c not in ("_op", pk, old_key)]
    row = lambda op, key: F.struct(op.alias("_op"), key.alias(pk), *rest)
    rows = F.when(moved, F.array(row(F.lit("D"), F.col(old_key)), row(F.col("_op"), F.col(pk)))).otherwise(F.array(row(F.col("_op"), F.col(pk))))
    return changes.select(F.explode(rows).alias("r")).select("r.*")


def after_truncate(changes: DataFrame, truncates: DataFrame, table: str = "table", lsn: str = "lsn") -> DataFrame:
    """Rows after the last truncate of their table."""
    last = truncates.groupBy(table).agg(F.max(lsn).alias("_cut"))
    return changes.join(F.broadcast(last), table, "left").where(F.col("_cut").isNull() | (F.col(lsn) > F.col("_cut"))).drop("_cut")


def flush_batches(changes: DataFrame, rows: int, by: list[str], order: list[str], lsn: str, size: Column) -> DataFrame:
    """Batches of at most ``rows`` rows a table: their positions, rows and estimated bytes. 0 rows: one batch."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    number = F.floor((rank - 1) / F.lit(rows)).cast("long") if rows else F.lit(0).cast("long")
    return (
        changes.withColumn("batch", number)
        .groupBy(*by, "batch")
        .agg(F.min(lsn).alias("lsn_low"), F.max(lsn).alias("lsn_high"), F.count("*").alias("n_rows"), F.sum(size).alias("n_bytes"))
    )


def schema_batches(changes: DataFrame, layout: str, by: list[str], order: list[str]) -> DataFrame:
    """``batch`` counts the layout changes so far: rows of different layouts never share one."""
    w = Window.partitionBy(*by).orderBy(*order)
    changed = (~F.col(layout).eqNullSafe(F.lag(layout).over(w)) & F.lag(F.lit(1)).over(w).isNotNull()).cast("long")
    return changes.withColumn("_changed", F.coalesce(changed, F.lit(0))).withColumn("batch", F.sum("_changed").over(w)).drop("_changed")


def patch_unchanged(changes: DataFrame, column: str, unchanged: str, pk: list[str], order: list[str]) -> DataFrame:
    """A column that was sent as unchanged gets the key's value before it."""
    w = Window.partitionBy(*pk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    known = F.last(F.when(~F.col(unchanged), F.struct(column)), ignorenulls=True).over(w)
    return changes.withColumn(column, known[column])


def null_deletes(changes: DataFrame, columns: list[str]) -> DataFrame:
    """Counts of deletes, and of those whose every column is NULL."""
    none = F.lit(True)
    for c in columns:
        none = none & F.col(c).isNull()
    return changes.where("_op = 'D'").agg(F.count("*").alias("deletes"), F.count(F.when(none, 1)).alias("null_deletes"))


def estimated_bytes(*values: Column) -> Column:
    """64 for a record, and the length of each value."""
    total = F.lit(64)
    for v in values:
        total = total + F.coalesce(F.octet_length(v.cast("string")), F.lit(0))
    return total


def transaction_sizes(changes: DataFrame) -> DataFrame:
    return changes.groupBy("xid").agg(F.count("*").alias("n"))


def route_audit(changes: DataFrame, audit: str, table: str = "table") -> tuple[DataFrame, DataFrame]:
    """(data, audit records)."""
    return changes.where(F.col(table) != audit), changes.where(F.col(table) == audit)


def resume_position(last_flushed: Column, consistent: Column) -> Column:
    return F.coalesce(last_flushed, consistent, F.lit(0).cast("long"))
