"""Rolling daily summary per sensor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.functions.numeric import round_numeric
from telemetra.functions.times import Instant, instant, rolling_window
from telemetra.schemas import FEATURES, SUMMARY

MAXIMA = ("pm2_5", "pm10", "no2", "temperature")
MINIMA = ("pm2_5",)


def aqi_frequency(readings: DataFrame) -> DataFrame:
    """Readings per sensor and air-quality class."""
    return readings.groupBy("sensor_id", "aqi_category").agg(F.count(F.lit(1)).alias("n"))


def _most_frequent() -> Column:
    """Class with the most readings; on a tie the first by name, a missing class last."""
    order = F.struct(-F.col("n"), F.col("aqi_category").isNull(), F.col("aqi_category"))
    return F.min_by("aqi_category", order).alias("dominant_aqi")


def dominant_aqi(readings: DataFrame) -> DataFrame:
    """Most frequent air-quality class of each sensor."""
    return aqi_frequency(readings).groupBy("sensor_id").agg(_most_frequent())


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("sensor_id").agg(F.count(F.lit(1)).cast("int").alias("anomaly_count"))


def sensor_stats(readings: DataFrame) -> DataFrame:
    """Unrounded statistics of each sensor."""
    return readings.groupBy("sensor_id").agg(
        *[F.avg(name).alias(f"avg_{name}") for name in FEATURES],
        *[F.max(name).alias(f"max_{name}") for name in MAXIMA],
        *[F.min(name).alias(f"min_{name}") for name in MINIMA],
        F.count(F.lit(1)).cast("int").alias("total_readings"),
    )


def stats_with_dominant(readings: DataFrame) -> DataFrame:
    """Statistics and most frequent class of each sensor from one pass over the readings.

    The readings are reduced once, to one row per sensor and class; statistics and class come from
    these few rows. A sensor with a large share of all readings costs no more than any other.
    """
    per_class = readings.groupBy("sensor_id", "aqi_category").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(name).cast("double")).alias(f"sum_{name}") for name in FEATURES],
        *[F.count(name).alias(f"n_{name}") for name in FEATURES],
        *[F.max(name).alias(f"max_{name}") for name in MAXIMA],
        *[F.min(name).alias(f"min_{name}") for name in MINIMA],
    )

    def mean(name: str) -> Column:
        total, present = F.sum(f"sum_{name}"), F.sum(f"n_{name}")
        return F.when(present > 0, total / present).alias(f"avg_{name}")

    return per_class.groupBy("sensor_id").agg(
        *[mean(name) for name in FEATURES],
        *[F.max(f"max_{name}").alias(f"max_{name}") for name in MAXIMA],
        *[F.min(f"min_{name}").alias(f"min_{name}") for name in MINIMA],
        F.sum("n").cast("int").alias("total_readings"),
        _most_frequent(),
    )


def with_anomaly_counts(stats: DataFrame, counts: DataFrame) -> DataFrame:
    """Left join: every sensor with readings stays, one without anomalies counts zero."""
    joined = stats.join(counts, "sensor_id", "left")
    return joined.withColumn("anomaly_count", F.coalesce("anomaly_count", F.lit(0)))


def with_dominant(stats: DataFrame, dominant: DataFrame) -> DataFrame:
    return stats.join(dominant, "sensor_id", "left")


def _rounded(name: str) -> Column:
    digits = 1 if name == "avg_humidity" else 2
    return round_numeric(F.col(name), digits).alias(name)


def present(stats: DataFrame, as_of: Instant) -> DataFrame:
    """Statistics of sensors as rows of the summary table."""
    computed = {"summary_date": F.to_date(instant(as_of)), "created_at": instant(as_of)}
    statistics = {name for name in SUMMARY.names if name[:4] in ("avg_", "max_", "min_")}

    def column(name: str) -> Column:
        if name in statistics:
            return _rounded(name)
        return computed.get(name, F.col(name)).alias(name)

    return stats.select(*[column(name) for name in SUMMARY.names])


def daily_summary(readings: DataFrame, anomalies: DataFrame, as_of: Instant) -> DataFrame:
    """Summary of the 24 hours before ``as_of``, labelled with its date.

    Sensors without a name form no group of their own in the join, as in SQL: a NULL sensor keeps
    its statistics and counts zero anomalies.
    """
    stats = stats_with_dominant(rolling_window(readings, as_of))
    counts = anomaly_counts(rolling_window(anomalies, as_of))
    return present(with_anomaly_counts(stats, counts), as_of)


def summary_report(summary: DataFrame, as_of: Instant) -> DataFrame:
    """The summary rows of one date, by sensor."""
    return (
        summary.filter(F.col("summary_date") == F.to_date(instant(as_of)))
        .select("sensor_id", "summary_date", "total_readings", "anomaly_count", "dominant_aqi")
        .orderBy("sensor_id")
    )


def summary_size(summary: DataFrame, as_of: Instant) -> DataFrame:
    """How many sensors the report of one date holds."""
    return summary.filter(F.col("summary_date") == F.to_date(instant(as_of))).agg(
        F.count(F.lit(1)).alias("total_sensors")
    )
