"""Readiness gates: one row holding 1 when a job may start, else 0."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.functions.times import Instant, instant, recent_window
from telemetra.rules import MIN_TRAINING_ROWS
from telemetra.schemas import FEATURES


def _gate(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).alias("ready")


def new_data_ready(readings: DataFrame, as_of: Instant, min_rows: int = MIN_TRAINING_ROWS) -> DataFrame:
    """Have enough readings arrived since 24 hours ago?"""
    return recent_window(readings, as_of).agg(_gate(F.count(F.lit(1)) >= min_rows))


def summary_ready(summary: DataFrame, as_of: Instant) -> DataFrame:
    """Is there a summary for the date?"""
    return summary.filter(F.col("summary_date") == F.to_date(instant(as_of))).agg(_gate(F.count(F.lit(1)) > 0))


def retrain_needed(training: DataFrame, recent: DataFrame, max_shift: float = 0.5) -> DataFrame:
    """Has any feature's mean moved by more than ``max_shift`` training standard deviations?

    A feature without spread in training counts as moved once its mean differs at all.
    """
    marked = training.select(*FEATURES, F.lit(False).alias("is_recent")).unionByName(
        recent.select(*FEATURES, F.lit(True).alias("is_recent"))
    )
    moments = marked.agg(
        *[F.avg(F.when(F.col("is_recent"), F.col(name))).alias(f"recent_mean_{name}") for name in FEATURES],
        *[F.avg(F.when(~F.col("is_recent"), F.col(name))).alias(f"mean_{name}") for name in FEATURES],
        *[F.stddev_samp(F.when(~F.col("is_recent"), F.col(name))).alias(f"std_{name}") for name in FEATURES],
    )

    def moved(name: str) -> Column:
        shift = F.abs(F.col(f"recent_mean_{name}") - F.col(f"mean_{name}"))
        return F.when(shift > F.col(f"std_{name}") * max_shift, F.lit(name))

    return moments.select(F.array_compact(F.array(*map(moved, FEATURES))).alias("moved")).select(
        F.when(F.size("moved") > 0, 1).otherwise(0).alias("retrain"),
        F.array_join("moved", ",").alias("moved_features"),
    )


def is_open(gate: DataFrame) -> bool:
    """Read a gate; it is a single row."""
    return gate.first()[0] == 1
