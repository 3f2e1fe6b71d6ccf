"""Training sets: extraction, validation, and the minimum-rows gate."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.functions.times import Instant, between_dates, closed_window, instant, recent_window
from telemetra.rules import MIN_TRAINING_ROWS, TRAINING_HUMIDITY
from telemetra.schemas import FEATURES

# The same as extract_range, for callers who keep their statements in SQL with named parameters.
EXTRACT_RANGE_SQL = """
SELECT row_id, pm2_5, pm10, no2, o3, temperature, humidity
FROM {readings}
WHERE event_time >= CAST(:start AS TIMESTAMP) AND event_time <= CAST(:end AS TIMESTAMP)
  AND event_date >= CAST(CAST(:start AS TIMESTAMP) AS DATE) AND event_date <= CAST(CAST(:end AS TIMESTAMP) AS DATE)
  AND pm2_5 IS NOT NULL
"""


class NotEnoughRows(ValueError):
    """Fewer valid rows than training needs."""


class EmptyRange(NotEnoughRows):
    """A range without any row."""


def _features(readings: DataFrame, row_id: str) -> DataFrame:
    return readings.filter(F.col(FEATURES[0]).isNotNull()).select(row_id, *FEATURES)


def extract_recent(readings: DataFrame, as_of: Instant, row_id: str = "row_id") -> DataFrame:
    """Features of the readings since 24 hours before ``as_of``."""
    return _features(recent_window(readings, as_of), row_id)


def extract_range(readings: DataFrame, start: Instant, end: Instant, row_id: str = "row_id") -> DataFrame:
    """Features of the readings in the closed range [start, end]."""
    return _features(closed_window(readings, start, end), row_id)


def extract_ranges(
    readings: DataFrame, ranges: dict[str, tuple[Instant, Instant]], row_id: str = "row_id"
) -> DataFrame:
    """Features of the readings in any of some closed ranges: a row (model_id, row_id, features) for each range that holds one.

    The ranges may overlap. Readings are read once, between the earliest start and the latest end.
    """
    starts, ends = ([instant(bound) for bound in bounds] for bounds in zip(*ranges.values()))
    first, last = (F.least(*starts), F.greatest(*ends)) if len(ranges) > 1 else (starts[0], ends[0])
    when = F.col("event_time")
    spans = [F.struct(F.lit(key).alias("model_id"), a.alias("a"), b.alias("b")) for key, a, b in zip(ranges, starts, ends)]
    holding = F.filter(F.array(*spans), lambda span: when.between(span["a"], span["b"]))
    inside = between_dates(readings, when.between(first, last), first, last).filter(F.col(FEATURES[0]).isNotNull())
    held = inside.select(F.col(row_id).alias("row_id"), *FEATURES, F.explode(holding).alias("span"))
    return held.select("span.model_id", "row_id", *FEATURES)


def extract_range_sql(spark: SparkSession, readings: DataFrame, start: str, end: str) -> DataFrame:
    """The same by a SQL statement. Its bounds on ``event_date`` let stored readings be pruned; others get the column."""
    if "event_date" not in readings.columns:
        readings = readings.withColumn("event_date", F.to_date("event_time"))
    return spark.sql(EXTRACT_RANGE_SQL, args={"start": start, "end": end}, readings=readings)


def is_complete(features: tuple[str, ...] = FEATURES) -> Column:
    """No feature is NULL, NaN or infinite, and humidity, if it is a feature, is in range."""

    def finite(name: str) -> Column:
        value = F.col(name).cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))

    present = [finite(name) for name in features]
    in_range = [F.col("humidity").between(*TRAINING_HUMIDITY)] if "humidity" in features else []
    return reduce(and_, present + in_range)


def validate(extracted: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """The complete rows."""
    return extracted.filter(is_complete(features))


def row_counts(extracted: DataFrame, by: tuple[str, ...] = (), features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Rows extracted, valid and rejected, in one pass."""
    counts = extracted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_extracted"),
        F.count_if(is_complete(features)).alias("n_valid"),
    )
    return counts.withColumn("n_rejected", F.col("n_extracted") - F.col("n_valid"))


def assert_enough(n_extracted: int, n_valid: int, min_rows: int = MIN_TRAINING_ROWS) -> int:
    """The number of valid rows, unless there are too few to train on."""
    if n_extracted == 0:
        raise EmptyRange("no readings in this period")
    if n_valid < min_rows:
        raise NotEnoughRows(f"{n_valid} valid rows, at least {min_rows} are needed")
    return n_valid


def checked_count(extracted: DataFrame, min_rows: int = MIN_TRAINING_ROWS) -> int:
    counts = row_counts(extracted).first()
    return assert_enough(counts["n_extracted"], counts["n_valid"], min_rows)
