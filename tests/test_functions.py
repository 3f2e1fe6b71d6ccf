from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from samples import flat
from telemetra.functions.air import anomaly_reason, aqi_category, heat_index, is_anomaly, is_labelled, severity
from telemetra.functions.keys import model_key, with_file_row_id
from telemetra.functions.numeric import round_numeric
from telemetra.functions.times import closed_window, event_time, instant, recent_window, rolling_window

NAN = float("nan")


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_aqi_boundaries(spark):
    cases = [
        (0.0, "good"), (12.0, "good"), (12.01, "moderate"), (35.4, "moderate"), (35.41, "unhealthy_sensitive"),
        (55.4, "unhealthy_sensitive"), (55.41, "unhealthy"), (150.0, "unhealthy"), (150.01, "hazardous"),
        (500.0, "hazardous"), (NAN, "hazardous"), (None, "unknown"),
    ]
    df = spark.createDataFrame(cases, "pm DOUBLE, expected STRING")
    assert df.filter(aqi_category(F.col("pm")) != F.col("expected")).count() == 0
    assert values(df, aqi_category(F.col("pm"))) == [expected for _, expected in cases]


def test_heat_index(spark):
    df = spark.createDataFrame([(22.5, 65), (0.0, 0), (-20.0, 89), (20.0, None)], "t DOUBLE, h INT")
    assert values(df, heat_index(F.col("t"), F.col("h"))) == [28.0, 0.0, -17.55, None]


@pytest.mark.parametrize(
    "row, flagged, reason, level",
    [
        ({"pm2_5": 35.4, "pm10": 50.0, "no2": 85.0, "o3": 100.0, "temperature": 40.0, "humidity": 85}, False, None, None),
        ({"pm2_5": 35.41, "pm10": 51.0}, True, "HIGH_PM2_5", "warning"),
        ({"pm2_5": 150.0}, True, "HIGH_PM2_5", "warning"),
        ({"pm2_5": 150.01}, True, "HIGH_PM2_5", "critical"),
        ({"pm10": 50.01, "no2": 86.0}, True, "HIGH_PM10", "warning"),
        ({"no2": 200.0, "o3": 101.0}, True, "HIGH_NO2", "warning"),
        ({"no2": 200.01}, True, "HIGH_NO2", "critical"),
        ({"o3": 100.01, "temperature": 41.0}, True, "HIGH_O3", "warning"),
        ({"temperature": 40.01, "humidity": 90}, True, "EXTREME_TEMP", "warning"),
        ({"humidity": 86}, True, "HIGH_HUMIDITY", "warning"),
        ({"no2": None, "o3": None}, None, None, None),
        ({"no2": None, "humidity": 86}, True, "HIGH_HUMIDITY", "warning"),
        ({"no2": NAN}, True, "HIGH_NO2", "critical"),
        ({"o3": NAN}, True, "HIGH_O3", "warning"),
        ({"no2": NAN, "pm2_5": 36.0}, True, "HIGH_PM2_5", "critical"),
    ],
)
def test_anomaly_rules(spark, row, flagged, reason, level):
    df = flat(spark, [row])
    found = df.select(is_anomaly(F.col), anomaly_reason(F.col), severity(F.col)).first()
    assert found[0] == flagged
    if flagged:
        assert (found[1], found[2]) == (reason, level)


def test_labels(spark):
    df = spark.createDataFrame([("true",), ("True",), ("false",), (None,), ("yes",)], "label STRING")
    assert values(df, is_labelled(F.col("label"))) == [True, True, False, False, False]


def test_round_numeric(spark):
    df = spark.createDataFrame(
        [(12.345,), (-12.345,), (0.125,), (1e20,), (None,), (0.0049999,), (2.675,)], "x DOUBLE"
    )
    assert values(df, round_numeric(F.col("x"), 2)) == [12.35, -12.35, 0.13, 1e20, None, 0.0, 2.68]
    nan = spark.createDataFrame([(NAN,)], "x DOUBLE")
    assert math.isnan(values(nan, round_numeric(F.col("x"), 2))[0])


def test_event_time(spark):
    texts = [
        "2024-01-15T14:30:00", "2024-01-15T14:30:00Z", "2024-01-15T14:30:00.123456", "2024-01-15T14:30:00+02:00",
        "2024-01-15", "garbage", "", None,
    ]
    df = spark.createDataFrame([(text,) for text in texts], "text STRING")
    stamps = values(df, event_time(F.col("text")).cast("string"))
    assert stamps == [
        "2024-01-15 14:30:00", "2024-01-15 14:30:00", "2024-01-15 14:30:00.123456", "2024-01-15 12:30:00",
        "2024-01-15 00:00:00", None, None, None,
    ]


def test_instant_takes_text_or_datetime(spark):
    df = spark.range(1)
    for at in ("2024-01-15 00:00:00", datetime(2024, 1, 15)):
        assert values(df, instant(at).cast("string")) == ["2024-01-15 00:00:00"]


def test_three_windows(spark):
    times = [datetime(2024, 1, 13, 23, 59, 59), datetime(2024, 1, 14), datetime(2024, 1, 15), datetime(2024, 1, 16)]
    df = flat(spark, [{"event_time": at} for at in times])
    as_of = "2024-01-15 00:00:00"
    assert sorted(values(rolling_window(df, as_of), "row_id")) == [1]
    assert sorted(values(recent_window(df, as_of), "row_id")) == [1, 2, 3]
    assert sorted(values(closed_window(df, "2024-01-14 00:00:00", as_of), "row_id")) == [1, 2]


def test_windows_prune_date_partitions(spark, tmp_path):
    times = [datetime(2024, 1, day, 12) for day in range(1, 31)]
    df = flat(spark, [{"event_time": at} for at in times]).withColumn("event_date", F.to_date("event_time"))
    df.write.partitionBy("event_date").parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    window = rolling_window(stored, "2024-01-15 00:00:00")
    assert [row["event_date"] for row in window.collect()] == [date(2024, 1, 14)]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(event_time)" in plan


def test_model_key(spark):
    df = spark.range(1)
    key = model_key(F.lit("2025-01-01 00:00:00"), F.lit("2025-12-31 23:59:59"))
    assert values(df, key) == ["isolation_forest_2025-01-01T00-00-00_to_2025-12-31T23-59-59"]


def test_file_row_ids_tell_copies_apart(spark, tmp_path):
    path = str(tmp_path / "copies")
    spark.range(1000).select(F.lit(1.0).alias("x")).repartition(3).write.parquet(path)
    keyed = with_file_row_id(spark.read.parquet(path))
    first = {row["row_id"] for row in keyed.collect()}
    again = {row["row_id"] for row in with_file_row_id(spark.read.parquet(path)).collect()}
    assert len(first) == 1000 and first == again
