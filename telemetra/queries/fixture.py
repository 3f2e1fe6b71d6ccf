"""Sensor data derived from the ``events`` table, as a pure projection of its rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.functions.times import instant
from telemetra.operators.clean import clean
from telemetra.operators.enrich import detect, enrich, flatten_anomalies, flatten_readings
from telemetra.session import pin_utc

AS_OF = "2024-01-15 00:00:00"
RANGE = ("2024-01-08 00:00:00", "2024-01-14 23:59:59")

# Read by Spark and by the SQL checks. Literals with an exponent keep the arithmetic in DOUBLE.
RAW_SQL = """
SELECT event_id,
  CASE WHEN event_id % 127 = 0 THEN NULL
       ELSE concat('CAP_', lpad(CAST(user_id % 20 AS VARCHAR(10)), 3, '0')) END AS sensor_id,
  CAST(ts AS TIMESTAMP) AS event_time,
  48e0 + CAST(user_id % 20 AS DOUBLE)/1e2 AS lat, 2e0 + CAST(user_id % 20 AS DOUBLE)/1e2 AS lon,
  CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 612.5e0 WHEN event_id % 211 = 0 THEN 35.4e0
       WHEN event_id % 223 = 0 THEN 12e0 WHEN event_id % 41 = 0 THEN 140e0 + CAST(h1 % 4000 AS DOUBLE)/1e2
       WHEN event_id % 13 = 0 THEN 35e0 + CAST(h1 % 3000 AS DOUBLE)/1e2 ELSE CAST(h1 % 3600 AS DOUBLE)/1e2 END AS pm2_5,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 103 = 0 THEN 650e0
       ELSE CAST(h2 % 5200 AS DOUBLE)/1e2 END AS pm10,
  CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 61 = 0 THEN 205e0
       ELSE CAST(h3 % 8700 AS DOUBLE)/1e2 END AS no2,
  CASE WHEN event_id % 67 = 0 THEN NULL ELSE CAST(h4 % 10200 AS DOUBLE)/1e2 END AS o3,
  CASE WHEN event_id % 107 = 0 THEN 75e0 WHEN event_id % 73 = 0 THEN 41.5e0
       ELSE CAST(h5 % 6000 AS DOUBLE)/1e2 - 20e0 END AS temperature,
  CAST(CASE WHEN event_id % 79 = 0 THEN NULL WHEN event_id % 109 = 0 THEN 120 ELSE h6 % 90 END AS INT) AS humidity,
  CASE WHEN event_id % 113 = 0 THEN NULL WHEN event_id % 37 = 0 THEN 'maintenance' ELSE 'active' END AS status,
  CASE WHEN event_id % 20 = 0 THEN 'true' ELSE 'false' END AS is_true_anomaly
FROM (
  SELECT event_id, user_id, ts,
    (event_id*7919) % 10007 AS h1, (event_id*104729+13) % 10007 AS h2, (event_id*1299709+7) % 10007 AS h3,
    (event_id*15485863+5) % 10007 AS h4, (event_id*32452843+3) % 10007 AS h5, (event_id*49979687+1) % 10007 AS h6
  FROM {events}
) AS hashed
"""

TIME_TEXT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table as a stream of its files.

    As a pattern the path may be one file or a folder of files; a plain path has to be a folder.
    """
    schema = events(spark, sf_dir).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.{{parquet}}")


def raw_of(source: DataFrame) -> DataFrame:
    """Flat raw readings, valid and invalid, keyed by row_id.

    The derived columns go through ``inline`` so that filters on them are not pushed below their
    derivation: evaluated twice, it makes a method too large for the JVM to compile. Filters on
    row_id and event_time still reach the scan.
    """
    derived = source.sparkSession.sql(RAW_SQL, events=source)
    fields = [name for name in derived.columns if name not in ("event_id", "event_time")]
    packed = derived.select(F.col("event_id").alias("row_id"), "event_time", F.struct(*fields).alias("fields"))
    return packed.select("row_id", "event_time", F.inline(F.array("fields")))


def parsed_of(source: DataFrame) -> DataFrame:
    """The same rows in the shape of a parsed message."""
    return raw_of(source).select(
        "row_id",
        "sensor_id",
        F.date_format("event_time", TIME_TEXT_FORMAT).alias("timestamp"),
        F.struct("lat", "lon").alias("location"),
        F.struct("pm2_5", "pm10", "no2", "o3", "temperature", "humidity").alias("measurements"),
        "status",
        "is_true_anomaly",
    )


def messages_of(source: DataFrame) -> DataFrame:
    """The same rows as messages: key text and JSON bytes. Producers send the label as a boolean."""
    parsed = parsed_of(source).withColumn("is_true_anomaly", F.col("is_true_anomaly") == "true")
    body = F.struct(*[name for name in parsed.columns if name != "row_id"])
    return parsed.select("row_id", F.col("sensor_id").alias("key"), F.to_json(body).cast("binary").alias("value"))


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_of(events(spark, sf_dir))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_of(events(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(events(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, enriched rows in the shape of a parsed message."""
    return enrich(clean(parsed(spark, sf_dir)), instant(AS_OF))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as the readings table holds them."""
    return flatten_readings(enrich(clean(raw(spark, sf_dir)), instant(AS_OF)), carry=("row_id",))


def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as the anomalies table holds them."""
    return flatten_anomalies(detect(enrich(clean(raw(spark, sf_dir)), instant(AS_OF))), carry=("row_id",))
