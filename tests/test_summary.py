from __future__ import annotations

import math
from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from samples import flat
from telemetra.operators import summary
from telemetra.operators.gates import is_open, new_data_ready, retrain_needed, summary_ready
from telemetra.operators.upsert import DuplicateKeys, assert_unique, duplicate_keys, upsert
from telemetra.queries import fixture
from telemetra.schemas import SUMMARY, SUMMARY_KEYS

import pytest

AS_OF = "2024-01-15 00:00:00"
NAN = float("nan")


def by_sensor(df) -> dict:
    return {row["sensor_id"]: row.asDict() for row in df.collect()}


def test_summary_schema(spark):
    df = flat(spark, [{}])
    found = summary.daily_summary(df, df, AS_OF).schema
    assert [(field.name, field.dataType) for field in found] == [(field.name, field.dataType) for field in SUMMARY]


def test_summary_values(spark):
    rows = [
        {"pm2_5": 10.0, "humidity": 50, "aqi_category": "good"},
        {"pm2_5": 20.005, "humidity": 51, "aqi_category": "moderate"},
        {"pm2_5": 30.0, "humidity": 51, "aqi_category": "moderate", "no2": None},
        {"pm2_5": 99.0, "event_time": datetime(2024, 1, 15)},
        {"pm2_5": 99.0, "event_time": datetime(2024, 1, 13, 23, 59, 59)},
        {"sensor_id": "quiet"},
    ]
    anomalies = flat(spark, [{}, {}, {"sensor_id": "no readings"}, {"event_time": datetime(2024, 1, 15)}])
    found = by_sensor(summary.daily_summary(flat(spark, rows), anomalies, AS_OF))
    assert set(found) == {"a", "quiet"}
    a = found["a"]
    assert (a["avg_pm2_5"], a["max_pm2_5"], a["min_pm2_5"]) == (20.0, 30.0, 10.0)
    assert (a["avg_humidity"], a["avg_no2"], a["total_readings"]) == (50.7, 10.0, 3)
    assert (a["anomaly_count"], a["dominant_aqi"], a["summary_date"]) == (2, "moderate", date(2024, 1, 15))
    assert found["quiet"]["anomaly_count"] == 0


def test_dominant_ties_and_missing_classes(spark):
    rows = [
        {"sensor_id": "tie", "aqi_category": "moderate"},
        {"sensor_id": "tie", "aqi_category": "good"},
        {"sensor_id": "null tie", "aqi_category": None},
        {"sensor_id": "null tie", "aqi_category": "hazardous"},
        {"sensor_id": "null most", "aqi_category": None},
        {"sensor_id": "null most", "aqi_category": None},
        {"sensor_id": "null most", "aqi_category": "good"},
    ]
    found = {row[0]: row[1] for row in summary.dominant_aqi(flat(spark, rows)).collect()}
    assert found == {"tie": "good", "null tie": "hazardous", "null most": None}


def test_nan_measurements_stay_nan(spark):
    df = flat(spark, [{"no2": NAN}, {"no2": 5.0}])
    row = summary.daily_summary(df, df, AS_OF).first()
    assert math.isnan(row["avg_no2"]) and math.isnan(row["max_no2"]) and row["avg_o3"] == 10.0


def test_a_column_without_values(spark):
    df = flat(spark, [{"o3": None}, {"o3": None}])
    assert summary.daily_summary(df, df, AS_OF).first()["avg_o3"] is None


def test_one_pass_equals_separate_operators(spark, sf_medium):
    readings = fixture.readings(spark, sf_medium)
    together = by_sensor(summary.stats_with_dominant(readings))
    apart = by_sensor(summary.with_dominant(summary.sensor_stats(readings), summary.dominant_aqi(readings)))
    assert set(together) == set(apart)
    for sensor, row in apart.items():
        for name, value in row.items():
            other = together[sensor][name]
            assert other == value if not isinstance(value, float) else math.isclose(other, value, rel_tol=1e-12)


def test_summary_does_not_depend_on_partitioning(spark, sf_medium):
    readings, anomalies = fixture.readings(spark, sf_medium), fixture.anomalies(spark, sf_medium)
    once = by_sensor(summary.daily_summary(readings, anomalies, AS_OF))
    spread = by_sensor(summary.daily_summary(readings.repartition(13), anomalies.repartition(7), AS_OF))
    assert once == spread and len(once) == 20


def test_hot_sensor_is_reduced_before_the_shuffle(spark, sf_medium):
    plan = summary.stats_with_dominant(fixture.readings(spark, sf_medium))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_sum(pm2_5") > text.index("Exchange hashpartitioning(sensor_id")
    assert text.count("FileScan") == 1


def test_report(spark):
    readings = flat(spark, [{"sensor_id": name} for name in "cab"])
    daily = summary.daily_summary(readings, readings, AS_OF)
    assert [row["sensor_id"] for row in summary.summary_report(daily, AS_OF).collect()] == ["a", "b", "c"]
    assert summary.summary_size(daily, AS_OF).first()[0] == 3
    assert summary.summary_size(daily, "2024-01-16 00:00:00").first()[0] == 0


def test_gates(spark):
    few, enough = flat(spark, [{}] * 49), flat(spark, [{}] * 49 + [{"event_time": datetime(2024, 2, 1)}])
    assert not is_open(new_data_ready(few, AS_OF)) and is_open(new_data_ready(enough, AS_OF))
    daily = summary.daily_summary(enough, enough, AS_OF)
    assert is_open(summary_ready(daily, AS_OF)) and not is_open(summary_ready(daily, "2024-01-16 00:00:00"))


def test_retrain_gate(spark):
    training = flat(spark, [{"pm2_5": float(value)} for value in (8, 9, 10, 11, 12)])
    same = flat(spark, [{"pm2_5": 10.1}])
    moved = flat(spark, [{"pm2_5": 14.0, "temperature": 20.5}])
    assert tuple(retrain_needed(training, same).first()) == (0, "")
    assert tuple(retrain_needed(training, moved).first()) == (1, "pm2_5,temperature")


KEYED = st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=8)


def table(spark, rows):
    return spark.createDataFrame([(key, key % 3, value) for key, value in rows.items()], "a INT, b INT, value INT")


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(KEYED, KEYED)
def test_upsert_overwrites_and_is_idempotent(spark, old, new):
    keys = ("a", "b")
    once = upsert(table(spark, old), table(spark, new), keys)
    twice = upsert(once, table(spark, new), keys)
    expected = {**old, **new}
    for result in (once, twice):
        assert sorted((row["a"], row["value"]) for row in result.collect()) == sorted(expected.items())


def test_upsert_keeps_rows_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1)], "a INT, value INT")
    assert upsert(df, df, ("a",)).count() == 2


def test_uniqueness(spark):
    readings = flat(spark, [{"sensor_id": name} for name in "ab"])
    daily = summary.daily_summary(readings, readings, AS_OF)
    assert_unique(daily, SUMMARY_KEYS)
    doubled = daily.unionByName(daily.filter("sensor_id = 'a'"))
    assert [row["n_rows"] for row in duplicate_keys(doubled, SUMMARY_KEYS).collect()] == [2]
    with pytest.raises(DuplicateKeys):
        assert_unique(doubled, SUMMARY_KEYS)
