"""Enrichment, anomaly detection, and the row shapes that leave the ETL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.functions.air import aqi_category, anomaly_reason, fields_of, heat_index, is_anomaly, severity
from telemetra.functions.times import event_time
from telemetra.schemas import ANOMALIES, READINGS

# Fields of the outgoing messages, which consumers know by these names.
PROCESSED_FIELDS = (
    "sensor_id",
    "timestamp",
    "measurements",
    "aqi_category",
    "heat_index",
    "processed_at",
    "is_true_anomaly",
)
ANOMALY_FIELDS = (
    "sensor_id",
    "timestamp",
    "measurements",
    "anomaly_reason",
    "severity",
    "processed_at",
    "is_true_anomaly",
)


def enrich(df: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Add air-quality class, heat index and processing time.

    In a stream the default is the time of the micro-batch, the same for all its rows and sinks;
    batch jobs pass their own ``as_of``.
    """
    field = fields_of(df)
    return df.withColumns(
        {
            "aqi_category": aqi_category(field("pm2_5")),
            "heat_index": heat_index(field("temperature"), field("humidity")),
            "processed_at": F.current_timestamp() if processed_at is None else processed_at,
        }
    )


def detect(df: DataFrame) -> DataFrame:
    """Rows above any threshold, with reason and severity."""
    field = fields_of(df)
    return df.filter(is_anomaly(field)).withColumns(
        {"anomaly_reason": anomaly_reason(field), "severity": severity(field)}
    )


def _event_time(df: DataFrame) -> Column:
    return F.col("event_time") if "event_time" in df.columns else event_time(F.col("timestamp"))


def _flatten(df: DataFrame, names: list[str], carry: tuple[str, ...]) -> DataFrame:
    field = fields_of(df)
    nested = {"event_time": _event_time(df)}
    if "location" in df.columns:
        nested |= {name: F.col(f"location.{name}") for name in ("lat", "lon")}
    if "measurements" in df.columns:
        nested |= {name: field(name) for name in df.schema["measurements"].dataType.names}
    return df.select(*carry, *[nested.get(name, F.col(name)).alias(name) for name in names])


def flatten_readings(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the readings table; ``carry`` keeps further columns in front."""
    return _flatten(df, READINGS.names, carry)


def flatten_anomalies(df: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows of the anomalies table."""
    return _flatten(df, ANOMALIES.names, carry)


def to_messages(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Messages keyed by sensor; fields that are NULL are left out of the JSON text."""
    return df.select(F.col("sensor_id").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def debug_projection(df: DataFrame) -> DataFrame:
    """The few columns worth watching on a console."""
    field = fields_of(df)
    return df.select(
        "sensor_id",
        "timestamp",
        field("pm2_5").alias("pm2_5"),
        field("temperature").alias("temp"),
        "aqi_category",
        "is_true_anomaly",
    )
