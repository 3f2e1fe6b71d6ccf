"""Keyed merge and the uniqueness check that goes with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """A key that must be unique occurs more than once."""


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows, and the old rows whose key has no new row."""
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    return kept.select(*new.columns).unionByName(new)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    example = duplicate_keys(df, keys).first()
    if example is not None:
        raise DuplicateKeys(f"duplicate key: {example.asDict()}")
