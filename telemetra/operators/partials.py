"""Statistics of sensors in mergeable form: one row for each sensor and hour, from which any window of whole hours follows.

A partial holds sums, counts, extremes, readings by air-quality class, and anomalies. Partials of the same sensor and hour
add up, so late readings need no correction of what is stored: theirs is one more partial of that hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra import rules
from telemetra.functions.air import is_anomaly
from telemetra.functions.times import Instant, hours_before, instant, rolling_window
from telemetra.operators.summary import MAXIMA, MINIMA, present
from telemetra.rules import SUMMARY_HOURS
from telemetra.schemas import FEATURES

# The classes that the rules assign; None counts readings that have none.
CLASSES = (*[label for _, label in rules.AQI_UPPER_BOUNDS], rules.AQI_ABOVE, rules.AQI_MISSING, None)
SUMS = ("n", *[f"sum_{name}" for name in FEATURES], *[f"n_{name}" for name in FEATURES], "n_anomalies")


def _class_count(label: str | None) -> str:
    return f"class_{label or 'none'}"


def measures() -> list[Column]:
    """Aggregates over readings."""
    category = F.col("aqi_category")
    return [
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(name).cast("double")).alias(f"sum_{name}") for name in FEATURES],
        *[F.count(name).alias(f"n_{name}") for name in FEATURES],
        F.count_if(F.coalesce(is_anomaly(F.col), F.lit(False))).alias("n_anomalies"),
        *[F.max(name).alias(f"max_{name}") for name in MAXIMA],
        *[F.min(name).alias(f"min_{name}") for name in MINIMA],
        *[F.count_if(category.eqNullSafe(F.lit(label))).alias(_class_count(label)) for label in CLASSES],
    ]


def merged() -> list[Column]:
    """The same aggregates over partials."""
    return [
        *[F.sum(name).alias(name) for name in (*SUMS, *map(_class_count, CLASSES))],
        *[F.max(f"max_{name}").alias(f"max_{name}") for name in MAXIMA],
        *[F.min(f"min_{name}").alias(f"min_{name}") for name in MINIMA],
    ]


def hourly_partials(readings: DataFrame) -> DataFrame:
    """One partial for each sensor and hour; ``event_time`` is the start of the hour. Readings without a time are in none."""
    hour = F.date_trunc("hour", "event_time").alias("event_time")
    return readings.filter("event_time IS NOT NULL").groupBy("sensor_id", hour).agg(*measures())


def merge_partials(partials: DataFrame, *by: str | Column) -> DataFrame:
    return partials.groupBy(*by).agg(*merged())


def _most_frequent() -> Column:
    """Class with the most readings; on a tie the first by name, a missing class last."""
    counted = [F.struct((-F.col(_class_count(label))).alias("n"), F.lit(label is None).alias("none"), F.lit(label).cast("string").alias("label")) for label in CLASSES]
    return F.array_min(F.array(*counted))["label"]


def with_statistics(partials: DataFrame) -> DataFrame:
    """Averages, counts and the most frequent class beside the extremes, one row for each partial."""
    means = {f"avg_{name}": F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}")) for name in FEATURES}
    counts = {"total_readings": F.col("n").cast("int"), "anomaly_count": F.col("n_anomalies").cast("int")}
    return partials.withColumns({**means, **counts, "dominant_aqi": _most_frequent()})


def edge_readings(readings: DataFrame, as_of: Instant, hours: int = SUMMARY_HOURS) -> DataFrame:
    """Readings of the window [as_of - hours, as_of) in hours that lie only partly in it; none if ``as_of`` is a full hour."""
    start, when = hours_before(as_of, hours), F.col("event_time")
    first_whole = F.date_trunc("hour", start - F.expr("INTERVAL 1 MICROSECOND")) + F.expr("INTERVAL 1 HOUR")
    return rolling_window(readings, as_of, hours).filter((when < first_whole) | (when >= F.date_trunc("hour", instant(as_of))))


def whole_hours(partials: DataFrame, as_of: Instant, hours: int = SUMMARY_HOURS) -> DataFrame:
    """Partials of the hours that lie in the window as a whole."""
    return rolling_window(partials, as_of, hours).filter(F.col("event_time") < F.date_trunc("hour", instant(as_of)))


def summary_from_partials(partials: DataFrame, as_of: Instant, readings: DataFrame | None = None) -> DataFrame:
    """The daily summary of the 24 hours before ``as_of`` from stored partials.

    Only if ``as_of`` is not a full hour are ``readings`` needed, for the two hours at the edges.
    """
    rows = whole_hours(partials, as_of).select("sensor_id", *_columns())
    if readings is not None:
        rows = rows.unionByName(hourly_partials(edge_readings(readings, as_of)).select("sensor_id", *_columns()))
    return present(with_statistics(merge_partials(rows, "sensor_id")), as_of)


def _columns() -> list[str]:
    return [*SUMS, *map(_class_count, CLASSES), *[f"max_{name}" for name in MAXIMA], *[f"min_{name}" for name in MINIMA]]
