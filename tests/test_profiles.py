from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import flat
from telemetra.operators import learned, profiles
from telemetra.operators.evaluate import label_eval
from telemetra.operators.learned import Shelf, UnknownPipeline
from telemetra.queries import fixture
from telemetra.schemas import FEATURES

START = datetime(2024, 1, 1)
BOUNDARY = "2024-01-24 00:00:00"


def test_lags_look_at_hours_not_rows(spark):
    hours = {0: 1.0, 1: 2.0, 3: 4.0, 4: 5.0}
    df = flat(spark, [{"event_time": START + timedelta(hours=h, minutes=5), "pm2_5": v} for h, v in hours.items()])
    first = int(START.timestamp()) // 3600
    rows = {row["hour"]: row for row in profiles.hourly_lags(df).collect()}
    base = min(rows)
    shown = {
        hour - base: (row["current"], row["lag_1"], row["lag_2"], row["lag_3"], row["next_hour"])
        for hour, row in rows.items()
    }
    assert base % 24 == 0 and abs(base - first) <= 24
    assert shown == {
        0: (1.0, None, None, None, 2.0),
        1: (2.0, 1.0, None, None, None),
        3: (4.0, None, 2.0, 1.0, 5.0),
        4: (5.0, 4.0, None, 2.0, None),
    }


def test_hourly_means(spark):
    df = flat(spark, [{"event_time": START + timedelta(minutes=m), "pm2_5": v} for m, v in ((1, 1.0), (59, 4.0))])
    row = profiles.hourly(df).first()
    assert (row["current"], row["n_readings"]) == (2.5, 2)


def daily_cycle(spark, days=10):
    hours = np.arange(days * 24)
    level = 20 + 10 * np.sin(2 * np.pi * hours / 24)
    rows = [{"event_time": START + timedelta(hours=int(h)), "pm2_5": float(v)} for h, v in zip(hours, level)]
    return flat(spark, rows)


def test_forecast_beats_persistence_on_a_daily_cycle(spark):
    df = daily_cycle(spark)
    forecast = profiles.forecast_next_hour(df, "2024-01-08 00:00:00")
    assert forecast.count() == 3 * 24
    last = forecast.orderBy(F.desc("hour")).first()
    assert last["next_hour"] is None and last["forecast"] is not None
    model = profiles.forecast_error(forecast, F.col("forecast")).first()
    naive = profiles.persistence_error(forecast).first()
    assert model["rmse"] < naive["rmse"] / 2


def test_forecast_without_history_is_an_error(spark):
    with pytest.raises(profiles.NothingToLearn):
        profiles.forecast_next_hour(daily_cycle(spark, days=1), "2023-01-01 00:00:00")


def test_clusters_separate_two_kinds_of_sensor(spark):
    rng = np.random.default_rng(5)
    rows = []
    for sensor in range(6):
        level = 10.0 if sensor < 3 else 100.0
        rows += [
            {"sensor_id": f"s{sensor}", "pm2_5": level + x, "pm10": level + x, "no2": level, "temperature": 20 + x}
            for x in map(float, rng.uniform(0, 1, 10))
        ]
    rows.append({"sensor_id": "once"})
    found = {row["sensor_id"]: row["cluster"] for row in profiles.sensor_clusters(flat(spark, rows), k=2).collect()}
    assert len({found[f"s{n}"] for n in range(3)}) == 1 and len({found[f"s{n}"] for n in range(3, 6)}) == 1
    assert found["s0"] != found["s3"] and found["once"] is None


def test_classifier_learns_a_planted_label(spark):
    rng = np.random.default_rng(9)
    rows = [
        {"pm2_5": float(x), "temperature": float(t), "is_true_anomaly": str(x > 90).lower()}
        for x, t in zip(rng.uniform(0, 100, 600), rng.uniform(0, 30, 600))
    ]
    held_out = profiles.classify_anomalies(flat(spark, rows))
    row = label_eval(held_out, F.col("is_flagged"), F.col("is_labelled")).first()
    assert 60 < held_out.count() < 180 and row["f1"] > 0.9


def test_classifier_needs_both_labels(spark):
    with pytest.raises(profiles.NothingToLearn):
        profiles.classify_anomalies(flat(spark, [{}] * 50))


# --- fitted pipelines that outlast a query


@pytest.fixture
def shelf(tmp_path):
    return Shelf(str(tmp_path / "shelf"))


def test_loaded_pipelines_give_the_same(spark, sf_small, shelf):
    readings = fixture.readings(spark, sf_small)
    hours, sensors = profiles.forecast_rows(readings).cache(), profiles.sensor_profile(readings).cache()
    jobs = [
        (profiles.fit_forecast(hours, BOUNDARY), profiles.apply_forecast, hours),
        (profiles.fit_clusters(sensors), profiles.apply_clusters, sensors),
        (profiles.fit_classifier(readings), profiles.apply_classifier, readings),
    ]
    for learned, apply, rows in jobs:
        assert shelf.save(spark, learned, "2024-01-15") == 1
        loaded = shelf.load(spark, learned.kind)
        assert (loaded.inputs, loaded.n_rows, loaded.metrics) == (learned.inputs, learned.n_rows, learned.metrics)
        before, after = apply(rows, learned).collect(), apply(rows, loaded).collect()
        assert sorted(map(str, before)) == sorted(map(str, after)) and len(after) == rows.count() > 0
    assert {(r.kind, r.version) for r in shelf.entries(spark).collect()} == {("forecast", 1), ("clusters", 1), ("classifier", 1)}


def test_versions_of_a_pipeline(spark, sf_small, shelf):
    sensors = profiles.sensor_profile(fixture.readings(spark, sf_small)).cache()
    assert shelf.versions(spark, "clusters") == [] and shelf.entries(spark).count() == 0
    with pytest.raises(UnknownPipeline):
        shelf.load(spark, "clusters")
    for k in (2, 3):
        shelf.save(spark, profiles.fit_clusters(sensors, k), "2024-01-15")
    assert shelf.versions(spark, "clusters") == [1, 2]
    groups = {v: {r.cluster for r in profiles.apply_clusters(sensors, shelf.load(spark, "clusters", v)).collect()} for v in (1, 2)}
    assert groups == {1: {0, 1}, 2: {0, 1, 2}} and shelf.entry(spark, "clusters")["metrics"]["k"] == 3.0
    with pytest.raises(UnknownPipeline):
        shelf.load(spark, "clusters", 7)


def test_two_savers_get_different_versions(spark, sf_small, shelf, monkeypatch):
    sensors = profiles.sensor_profile(fixture.readings(spark, sf_small)).cache()
    learned_model = profiles.fit_clusters(sensors, 2)
    put, between = learned.write_once, [1]

    def slow(*arguments):
        if between:
            between.pop()
            shelf.save(spark, learned_model, "other")
        return put(*arguments)

    monkeypatch.setattr(learned, "write_once", slow)
    assert shelf.save(spark, learned_model, "mine") == 2
    assert [shelf.entry(spark, "clusters", v)["created_at"] for v in (1, 2)] == ["other", "mine"]


def test_a_pipeline_that_is_not_saved_whole_has_no_version(spark, sf_small, shelf, monkeypatch):
    sensors = profiles.sensor_profile(fixture.readings(spark, sf_small)).cache()
    fitted = profiles.fit_clusters(sensors, 2)

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(learned, "write_once", lost)
    with pytest.raises(RuntimeError):
        shelf.save(spark, fitted, "x")
    monkeypatch.undo()
    assert shelf.versions(spark, "clusters") == [] and shelf.save(spark, fitted, "x") == 1


def test_rows_without_a_feature_stay_and_are_not_judged(spark, sf_small, tmp_path):
    readings = fixture.readings(spark, sf_small)
    model = profiles.fit_classifier(readings)
    found = profiles.apply_classifier(readings.select("row_id", *FEATURES), model)
    missing = F.col("no2").isNull() | F.col("o3").isNull()
    counts = found.agg(F.count(F.lit(1)), F.count_if(missing), F.count_if(F.col("is_flagged").isNull()), F.count_if(F.col("probability").isNull())).first()
    assert counts[0] == readings.count() and counts[1] == counts[2] == counts[3] > 0
    assert found.filter(missing & F.col("is_flagged").isNotNull()).isEmpty()
    # The same on a stream.
    readings.select("row_id", *FEATURES).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(found.select("row_id", *FEATURES).schema).parquet(str(tmp_path / "in"))
    sink = profiles.apply_classifier(stream, model).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint"))
    sink.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    streamed = spark.read.schema(found.schema).parquet(str(tmp_path / "out"))
    assert streamed.exceptAll(found).isEmpty() and streamed.count() == counts[0]
