"""The summary of every sensor over sliding windows of a day, kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.functions.numeric import round_numeric
from telemetra.operators.enrich import flatten_readings
from telemetra.operators.partials import measures, merged, with_statistics
from telemetra.schemas import SUMMARY

WINDOW, STEP = "24 hours", "1 hour"


def rolling_summary(enriched: DataFrame, delay: str, window: str = WINDOW, step: str = STEP) -> DataFrame:
    """A row (as_of, sensor_id, statistics) for each sensor and window [as_of - 24 hours, as_of), one window an hour.

    Readings are reduced by hour first, and windows take these partials, so a reading enters the state once and not once
    for each of its 24 windows. ``step`` must divide ``window``. For a stream to be written in append mode: a window is
    sent once, when the watermark, the latest event time less ``delay``, has reached its end. A reading that comes after
    its hour was closed is dropped and changes no window; one that comes before changes all windows that hold it.
    The statistics are those of the daily summary at ``as_of``.
    """
    readings = flatten_readings(enriched).filter("event_time IS NOT NULL").withWatermark("event_time", delay)
    hourly = readings.groupBy(F.window("event_time", step).alias("hour"), "sensor_id").agg(*measures())
    inside = F.window(F.window_time("hour"), window, step).alias("day")
    daily = with_statistics(hourly.groupBy(inside, "sensor_id").agg(*merged()))
    names = [name for name in SUMMARY.names if name not in ("summary_date", "sensor_id", "created_at")]
    digits = {"avg_humidity": 1}
    shown = [round_numeric(F.col(name), digits.get(name, 2)).alias(name) if name[:4] in ("avg_", "max_", "min_") else F.col(name) for name in names]
    return daily.select(F.col("day.end").alias("as_of"), "sensor_id", *shown)
