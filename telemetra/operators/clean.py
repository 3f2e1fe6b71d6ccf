"""Validation of parsed messages."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.functions.air import fields_of
from telemetra.rules import ACTIVE_STATUS, VALID_RANGES


def valid_rules(df: DataFrame) -> dict[str, Column]:
    """Every validation rule by name; each may be NULL, which counts as not met."""
    field = fields_of(df)
    checks = {"sensor_id": F.col("sensor_id").isNotNull()}
    if "measurements" in df.columns:
        checks["measurements"] = F.col("measurements").isNotNull()
    checks["status"] = F.col("status") == ACTIVE_STATUS
    for name, low, high in VALID_RANGES:
        checks[name] = field(name).between(low, high)
    return checks


def valid(df: DataFrame) -> Column:
    """All rules at once; NULL where a rule cannot be decided."""
    return reduce(and_, valid_rules(df).values())


def clean(df: DataFrame) -> DataFrame:
    """Rows that meet every rule. A plain conjunction, so its parts can reach a parquet scan."""
    return df.filter(valid(df))


def rejected(df: DataFrame) -> DataFrame:
    """The exact complement of ``clean``: an undecided row is rejected as well."""
    return df.filter(~F.coalesce(valid(df), F.lit(False)))


def quality_report(df: DataFrame) -> DataFrame:
    """One row: rows in, rows kept, rows rejected, and rows failing each rule, in one pass."""
    met = F.coalesce(valid(df), F.lit(False))
    failures = [
        F.count_if(~F.coalesce(check, F.lit(False))).alias(f"failed_{name}") for name, check in valid_rules(df).items()
    ]
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(met).alias("n_valid"),
        F.count_if(~met).alias("n_rejected"),
        *failures,
    )
