"""Reconciling a new snapshot with what the lake holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _shape(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def resync_upserts(old: DataFrame, new: DataFrame, pk: list[str]) -> DataFrame:
    """New or changed rows. Equal schemas: a NULL-safe set difference; else every row of ``new`` (new keys, and common keys rewritten)."""
    if _shape(old) == _shape(new):
        return new.subtract(old)
    keys = old.select(*pk).distinct()
    return new.join(keys, pk, "left_anti").unionByName(new.join(keys, pk, "left_semi"))


def resync_deletes(old: DataFrame, new: DataFrame, pk: list[str]) -> DataFrame:
    return old.select(*pk).subtract(new.select(*pk))


def apply_diff(old: DataFrame, ups: DataFrame, dels: DataFrame, pk: list[str]) -> DataFrame:
    """The new state: upserts hide the old version of their keys too."""
    gone = dels.select(*pk).unionByName(ups.select(*pk))
    return old.join(gone, pk, "left_anti").unionByName(ups, allowMissingColumns=True)


def load_with_deletes(data: DataFrame, deletes: DataFrame, pk: list[str]) -> DataFrame:
    """Old rows that no delete key names; NULL keys match nothing."""
    return data.join(deletes.select(*pk).distinct(), pk, "left_anti")
