"""Continuous merge of staged change files into a table, each micro-batch one commit, each batch at most once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.plans.table import Table


def changes(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def merge_into(stream: DataFrame, table: Table, checkpoint: str, name: str, seconds: int | None = None) -> StreamingQuery:
    """Runs on what is there (seconds None) or every so many seconds. A batch that a restart repeats is in the log already."""

    def one(batch: DataFrame, number: int) -> None:
        table.merge(batch, source={"query": name, "batch": number})

    out = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if seconds is None else out.trigger(processingTime=f"{seconds} seconds")).start()


def backoff(failures: int, first: float = 1.0, most: float = 30.0, total: float = 300.0) -> list[float]:
    """Waits before each new try: doubling up to ``most``, together at most ``total``."""
    out, wait = [], first
    for _ in range(failures):
        if sum(out) + wait > total:
            break
        out.append(wait)
        wait = min(2 * wait, most)
    return out
