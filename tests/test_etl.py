from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from samples import flat, message, messages
from telemetra.functions.times import instant
from telemetra.operators.clean import clean, quality_report, rejected
from telemetra.operators.enrich import (
    ANOMALY_FIELDS,
    PROCESSED_FIELDS,
    debug_projection,
    detect,
    enrich,
    flatten_anomalies,
    flatten_readings,
    to_messages,
)
from telemetra.queries import fixture
from telemetra.schemas import ANOMALIES, MESSAGE, READINGS
from telemetra.sources.messages import parse

NAN = float("nan")


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    "body",
    ['{"sensor_id":"a","measurements":{"pm2_5":1', "hello", "", None, '[{"sensor_id":"z"}]'],
)
def test_unreadable_messages_are_dropped(spark, body):
    parsed = parse(messages(spark, [body, message()]))
    assert parsed.count() == 2
    assert [row["row_id"] for row in clean(parsed).collect()] == [1]


@pytest.mark.parametrize(
    "change, kept",
    [
        ({"humidity": 65.0}, False),
        ({"pm2_5": "12.5"}, False),
        ({"pm2_5": "NaN"}, False),
        ({"measurements": None}, False),
        ({"sensor_id": None}, False),
        ({"status": "maintenance"}, False),
        ({"status": None}, False),
        ({"pm2_5": 500}, True),
        ({"pm2_5": 500.01}, False),
        ({"pm10": 600}, True),
        ({"pm10": -0.01}, False),
        ({"temperature": -50}, True),
        ({"temperature": 60.01}, False),
        ({"humidity": 100}, True),
        ({"humidity": 101}, False),
        ({"no2": None, "o3": None}, True),
        ({"no2": "NaN"}, True),
        ({"location": None}, True),
        ({"timestamp": "garbage"}, True),
    ],
)
def test_validation(spark, change, kept):
    parsed = parse(messages(spark, [message(**change)]))
    assert clean(parsed).count() == int(kept)
    assert rejected(parsed).count() == int(not kept)


def test_parse_keeps_the_declared_fields(spark):
    row = parse(messages(spark, [message()])).first()
    assert parse(messages(spark, [message()])).columns == ["row_id", *MESSAGE.names]
    assert row["is_true_anomaly"] == "true" and row["measurements"]["humidity"] == 52


def test_text_is_parsed_once(spark):
    """Also with filters on several fields and a projection on top."""
    df = detect(enrich(clean(parse(messages(spark, [message()])))))
    assert plan_of(flatten_anomalies(df)).count("from_json") == 1


def test_message_ids(spark):
    base = messages(spark, [message(), message()]).drop("row_id")
    by_content = {row["row_id"] for row in parse(base).collect()}
    placed = base.withColumns({"topic": F.lit("raw_data"), "partition": F.lit(0)})
    by_place = {row["row_id"] for row in parse(placed.withColumn("offset", F.monotonically_increasing_id())).collect()}
    assert len(by_content) == 1 and len(by_place) == 2


def test_row_shapes(spark):
    enriched = enrich(clean(parse(messages(spark, [message(no2=201)]))), instant("2024-01-15 00:00:00"))
    readings, anomalies = flatten_readings(enriched), flatten_anomalies(detect(enriched))
    kinds = lambda schema: [(field.name, field.dataType) for field in schema]
    assert kinds(readings.schema) == kinds(READINGS)
    assert kinds(anomalies.schema) == kinds(ANOMALIES)
    assert anomalies.first()["severity"] == "critical"
    assert str(readings.first()["event_time"]) == "2024-02-06 09:45:00"


def test_processing_time_is_one_value_per_batch(spark):
    enriched = enrich(clean(parse(messages(spark, [message()] * 50).repartition(4))))
    assert enriched.select("processed_at").distinct().count() == 1


def test_unreadable_time_is_kept_as_null(spark):
    enriched = enrich(clean(parse(messages(spark, [message(timestamp="garbage")]))))
    assert flatten_readings(enriched).first()["event_time"] is None


def test_messages_leave_out_missing_fields(spark):
    enriched = enrich(clean(parse(messages(spark, [message(no2=None, pm2_5=36)]))), instant("2024-01-15 00:00:00"))
    processed = to_messages(enriched, PROCESSED_FIELDS).first()
    body = json.loads(processed["value"])
    assert processed["key"] == "a"
    assert tuple(body) == PROCESSED_FIELDS and "no2" not in body["measurements"]
    found = json.loads(to_messages(detect(enriched), ANOMALY_FIELDS).first()["value"])
    assert tuple(found) == ANOMALY_FIELDS and found["anomaly_reason"] == "HIGH_PM2_5"


def test_debug_columns(spark):
    columns = debug_projection(enrich(clean(parse(messages(spark, [message()]))))).columns
    assert columns == ["sensor_id", "timestamp", "pm2_5", "temp", "aqi_category", "is_true_anomaly"]


NUMBER = st.one_of(st.none(), st.just(NAN), st.floats(-100, 700, allow_nan=False))
ROW = st.fixed_dictionaries(
    {
        "sensor_id": st.sampled_from(["a", None]),
        "status": st.sampled_from(["active", "maintenance", None]),
        "pm2_5": NUMBER,
        "pm10": NUMBER,
        "temperature": NUMBER,
        "humidity": st.one_of(st.none(), st.integers(-5, 120)),
    }
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=30))
def test_clean_and_rejected_split_the_input(spark, rows):
    df = flat(spark, rows)
    kept = {row["row_id"] for row in clean(df).collect()}
    dropped = {row["row_id"] for row in rejected(df).collect()}
    assert not kept & dropped and kept | dropped == set(range(len(rows)))
    report = quality_report(df).first()
    assert (report["n_rows"], report["n_valid"], report["n_rejected"]) == (len(rows), len(kept), len(dropped))
    assert report["failed_humidity"] == sum(r["humidity"] is None or not 0 <= r["humidity"] <= 100 for r in rows)


def test_golden_counts(spark, sf_medium):
    readings, anomalies = fixture.readings(spark, sf_medium), fixture.anomalies(spark, sf_medium)
    assert fixture.raw(spark, sf_medium).count() == 10_000
    assert readings.count() == 8_876 and anomalies.count() == 1_828
    classes = {row["aqi_category"]: row["count"] for row in readings.groupBy("aqi_category").count().collect()}
    assert classes == {
        "moderate": 5042, "good": 2869, "unhealthy_sensitive": 569, "unhealthy": 246, "hazardous": 150,
    }
    reasons = anomalies.groupBy("anomaly_reason", "severity").count().collect()
    assert {tuple(row) for row in reasons} == {
        ("HIGH_PM2_5", "warning", 800), ("HIGH_PM2_5", "critical", 165), ("HIGH_PM10", "warning", 154),
        ("HIGH_NO2", "warning", 147), ("HIGH_NO2", "critical", 130), ("HIGH_O3", "warning", 2),
        ("EXTREME_TEMP", "warning", 102), ("HIGH_HUMIDITY", "warning", 328),
    }
