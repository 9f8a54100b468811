"""The corpus pipeline: quality, line, near-duplicate and substring filters, then packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of ``documents``.

An executor serves stage after stage, and what one needed once would stay beside what the next needs: heap that
holds garbage is given back before each stage, and Python workers get few texts at once.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import line_dedup, near_dup, packing, quality, substring_dedup
from tidemark.llm.common import cut, few_at_once, give_back


def _lean(stage):
    """The stage, begun with little memory in use and with small batches."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        give_back(spark)
        with few_at_once(spark):
            return stage(spark, docs, sf_dir)

    return run


@_lean
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score below 0.5."""
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@_lean
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops later copies of lines, and documents that lose all their lines."""
    return line_dedup.dedup(docs)


@_lean
def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each class of near copies, repeated rows and null ids included."""
    return near_dup.keep(docs, null_ids=True)


@_lean
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages of 200 bytes or more."""
    return substring_dedup.remove(docs)


@_lean
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the remaining texts into sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_dup", near_dup_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

#: No SQL expresses training, signatures or packing; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
