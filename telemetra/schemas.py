"""Declared schemas. Nothing in the engine infers a schema.

Fixed values: names, types and order of message fields and table columns are the wire and storage formats.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


STRING, DOUBLE, INT, LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
TIMESTAMP, DATE = T.TimestampType(), T.DateType()

# Column order of the model features.
FEATURES = ("pm2_5", "pm10", "no2", "o3", "temperature", "humidity")

LOCATION = _struct(("lat", DOUBLE), ("lon", DOUBLE))

MEASUREMENTS = _struct(
    ("pm2_5", DOUBLE),
    ("pm10", DOUBLE),
    ("no2", DOUBLE),
    ("o3", DOUBLE),
    ("temperature", DOUBLE),
    ("humidity", INT),
)

MESSAGE = _struct(
    ("sensor_id", STRING),
    ("timestamp", STRING),
    ("location", LOCATION),
    ("measurements", MEASUREMENTS),
    ("status", STRING),
    ("is_true_anomaly", STRING),
)

READINGS = _struct(
    ("sensor_id", STRING),
    ("event_time", TIMESTAMP),
    ("lat", DOUBLE),
    ("lon", DOUBLE),
    ("pm2_5", DOUBLE),
    ("pm10", DOUBLE),
    ("no2", DOUBLE),
    ("o3", DOUBLE),
    ("temperature", DOUBLE),
    ("humidity", INT),
    ("aqi_category", STRING),
    ("heat_index", DOUBLE),
    ("processed_at", TIMESTAMP),
    ("is_true_anomaly", STRING),
)

ANOMALIES = _struct(
    ("sensor_id", STRING),
    ("event_time", TIMESTAMP),
    ("pm2_5", DOUBLE),
    ("pm10", DOUBLE),
    ("no2", DOUBLE),
    ("o3", DOUBLE),
    ("temperature", DOUBLE),
    ("humidity", INT),
    ("anomaly_reason", STRING),
    ("severity", STRING),
    ("processed_at", TIMESTAMP),
    ("is_true_anomaly", STRING),
)

SUMMARY = _struct(
    ("summary_date", DATE),
    ("sensor_id", STRING),
    ("avg_pm2_5", DOUBLE),
    ("max_pm2_5", DOUBLE),
    ("min_pm2_5", DOUBLE),
    ("avg_pm10", DOUBLE),
    ("max_pm10", DOUBLE),
    ("avg_no2", DOUBLE),
    ("max_no2", DOUBLE),
    ("avg_o3", DOUBLE),
    ("avg_temperature", DOUBLE),
    ("max_temperature", DOUBLE),
    ("avg_humidity", DOUBLE),
    ("total_readings", INT),
    ("anomaly_count", INT),
    ("dominant_aqi", STRING),
    ("created_at", TIMESTAMP),
)

SUMMARY_KEYS = ("summary_date", "sensor_id")

# Mergeable statistics of a sensor and hour; event_time is the start of the hour.
HOURLY = _struct(
    ("sensor_id", STRING),
    ("event_time", TIMESTAMP),
    ("n", LONG),
    *[(f"sum_{name}", DOUBLE) for name in FEATURES],
    *[(f"n_{name}", LONG) for name in FEATURES],
    ("n_anomalies", LONG),
    *[(f"max_{name}", DOUBLE) for name in ("pm2_5", "pm10", "no2", "temperature")],
    ("min_pm2_5", DOUBLE),
    *[(f"class_{name}", LONG) for name in ("good", "moderate", "unhealthy_sensitive", "unhealthy", "hazardous", "unknown", "none")],
)

# What the sinks add to a stored row: surrogate key and the two partition columns.
ROW_ID = T.StructField("row_id", LONG)
STORED_PARTITIONS = _struct(("event_date", DATE), ("batch_id", LONG))

FOREST_NODES = _struct(
    ("model_id", STRING),
    ("tree_id", INT),
    ("node_id", INT),
    ("feature", INT),
    ("threshold", DOUBLE),
    ("left", INT),
    ("right", INT),
    ("size", INT),
    ("depth", INT),
    ("path_length", DOUBLE),
)

MODELS = _struct(
    ("model_id", STRING),
    ("created_at", TIMESTAMP),
    ("n_rows", LONG),
    ("n_trees", INT),
    ("sample_size", INT),
    ("max_samples", INT),
    ("seed", LONG),
    ("features", STRING),
    ("contamination", DOUBLE),
    ("threshold", DOUBLE),
    ("anomaly_rate", DOUBLE),
    ("health_score", DOUBLE),
)

SCORES = _struct(
    ("sensor_id", STRING),
    ("event_time", TIMESTAMP),
    ("score", DOUBLE),
    ("prediction", INT),
    ("model_id", STRING),
)

PROMOTIONS = _struct(("model_id", STRING), ("promoted_at", TIMESTAMP))


def stored(schema: T.StructType) -> T.StructType:
    """Schema of a stored table: surrogate key first, partition columns last."""
    return T.StructType([ROW_ID, *schema.fields, *STORED_PARTITIONS.fields])
