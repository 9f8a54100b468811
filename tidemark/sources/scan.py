"""Planning snapshot scans by page ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def plan(pages: int, rows_per_page: int, rows_per_partition: int) -> list[tuple[int, int, int]]:
    """(number, first page, page after the last); an empty table has one empty range."""
    if pages <= 0:
        return [(0, 0, 0)]
    step = pages if rows_per_page <= 0 or rows_per_partition <= 0 else max(1, -(-rows_per_partition // rows_per_page))
    return [(i, s, min(s + step, pages)) for i, s in enumerate(range(0, pages, step))]


def predicates(ranges: list[tuple[int, int, int]]) -> list[str]:
    """For ``spark.read.jdbc(predicates=...)``; the last range is open-ended, so rows beyond stale statistics are read."""
    last = len(ranges) - 1
    return [f"ctid >= '({a},0)'::tid" + ("" if i == last else f" AND ctid < '({b},0)'::tid") for i, a, b in ranges]


def plan_frame(spark: SparkSession, pages: int, step: int) -> DataFrame:
    """The same ranges as a DataFrame."""
    return spark.range(0, max(pages, 1), max(step, 1)).select((F.col("id") / step).cast("long").alias("part"), F.col("id").alias("start_page"), F.least(F.col("id") + step, F.lit(pages)).alias("end_page"))


def assign(rows: DataFrame, page: str, ranges: list[tuple[int, int, int]]) -> DataFrame:
    """Each row with the ``part`` whose pages hold it; the last range is open-ended. Ranges are equally wide, as planned."""
    step = max(1, ranges[0][2] - ranges[0][1])
    return rows.withColumn("part", F.least(F.expr(f"`{page}` div {step}"), F.lit(len(ranges) - 1).cast("long")))


def backfill(rows: DataFrame, page: str, ranges: list[tuple[int, int, int]], folder: str, done: set[int] = frozenset()) -> list[tuple[int, str]]:
    """(range, path) of the ranges that were not done before, written as Parquet in one job, each to a folder of its own."""
    left = [i for i, *_ in ranges if i not in done]
    if not left:
        return []
    mine = assign(rows, page, ranges).where(F.col("part").isin(left))
    mine.repartition(len(left), "part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(folder)
    return [(i, f"{folder}/part={i}") for i in left]


def orphans(files: DataFrame, tracked: DataFrame, now: str, hours: int = 1) -> DataFrame:
    """Parquet and spill files nobody tracks that are older than ``hours``."""
    old = F.col("modified") < F.lit(now).cast("timestamp") - F.make_interval(hours=F.lit(hours))
    return files.where((F.col("path").endswith(".parquet") | F.col("path").endswith(".spill")) & old).join(tracked.select("path"), "path", "left_anti")
