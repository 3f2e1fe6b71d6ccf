from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from telemetra.__main__ import main
from telemetra.functions.times import instant
from telemetra.operators import registry
from telemetra.operators.forest import ForestSpec, predict
from telemetra.plans.backfill import BackfillFailed, model_keys, run_backfill
from telemetra.plans.daily import NotReady, run_summary, run_training
from telemetra.queries import fixture
from telemetra.streaming.etl import file_sinks, run_etl
from telemetra.tables import Store, Table
from telemetra.versions import VersionedTable

AS_OF = "2024-01-15 00:00:00"


@pytest.fixture(scope="module")
def store(spark, sf_medium, tmp_path_factory):
    root = tmp_path_factory.mktemp("installation")
    store = Store(str(root / "tables"))
    store.create(spark)
    stream = fixture.messages_of(fixture.event_stream(spark, sf_medium))
    run_etl(stream, file_sinks(store), str(root / "checkpoint"), processed_at=instant(AS_OF)).awaitTermination()
    return store


def test_from_messages_to_a_promoted_model(spark, store):
    spec = ForestSpec(n_trees=20)
    with pytest.raises(NotReady, match="summary"):
        run_training(spark, store, "first", AS_OF, spec)

    report = run_summary(spark, store, AS_OF).collect()
    assert [row["sensor_id"] for row in report] == [f"CAP_{n:03}" for n in range(20)]
    assert sum(row["total_readings"] for row in report) == 289
    assert sum(row["anomaly_count"] for row in report) == 59
    assert {row["sensor_id"]: row["dominant_aqi"] for row in report}["CAP_019"] is not None
    assert run_summary(spark, store, AS_OF).collect() == report

    first = run_training(spark, store, "first", AS_OF, spec)
    assert first.decision == "promote" and first.health_score > 0.99
    again = run_training(spark, store, "second", AS_OF, spec)
    assert again.health_score == first.health_score and again.decision == "keep"

    current = registry.current_model(store.models.read(spark), store.promotions.read(spark)).first()
    assert current["model_id"] == "first" and store.models.read(spark).count() == 2
    loaded = registry.load_forest(store, spark, "first")
    flagged = predict(store.readings.read(spark), loaded).filter("prediction = -1").count()
    assert 0 < flagged < 0.1 * 8_876


def test_no_new_readings(spark, store):
    with pytest.raises(NotReady, match="readings"):
        run_training(spark, store, "late", "2030-01-01 00:00:00")


def test_jobs_from_the_command_line(spark, sf_medium, tmp_path, capsys):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "tables")
    fixture.messages(spark, sf_medium).drop("row_id").write.parquet(landing)
    main(["ingest", "--root", root, "--path", landing, "--checkpoint", str(tmp_path / "checkpoint")])
    main(["summary", "--root", root, "--as-of", AS_OF])
    assert "CAP_019" in capsys.readouterr().out
    main(["train", "--root", root, "--as-of", AS_OF, "--model-id", "daily"])
    assert "promote" in capsys.readouterr().out
    bounds = ["--start", "2024-01-01 00:00:00", "--end", "2024-01-15 00:00:00"]
    main(["backfill", "--root", root, "--as-of", AS_OF, *bounds, "--contamination", "0.1"])
    store = Store(root)
    assert store.readings.read(spark).count() == 8_876
    models = {row["model_id"]: row for row in store.models.read(spark).collect()}
    past = "isolation_forest_2024-01-01T00-00-00_to_2024-01-15T00-00-00"
    assert set(models) == {"daily", past}
    assert models[past]["anomaly_rate"] == pytest.approx(0.1, abs=0.005)
    assert [row["model_id"] for row in store.promotions.read(spark).collect()] == ["daily"]
    assert registry.load_forest(store, spark, past).threshold == models[past]["threshold"]


def test_command_line_wants_one_source(capsys):
    with pytest.raises(SystemExit):
        main(["ingest", "--root", "r", "--checkpoint", "c"])
    assert "--servers" in capsys.readouterr().err


def test_backfill_keeps_good_ranges_and_names_bad_ones(spark, tmp_path, sf_medium):
    store = Store(str(tmp_path / "tables"))
    store.create(spark)
    readings = fixture.readings(spark, sf_medium).withColumn("event_date", F.to_date("event_time"))
    rows = readings.withColumn("batch_id", F.lit(0)).withColumn("heat_index", F.lit(0.0))
    for field in store.readings.schema:
        if field.name not in rows.columns:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
    store.readings.replace_partitions(rows)
    good, empty = ("2024-01-01 00:00:00", "2024-01-10 23:59:59"), ("2030-01-01 00:00:00", "2030-01-02 00:00:00")
    with pytest.raises(BackfillFailed) as failed:
        run_backfill(spark, store, [good, empty, good], "2024-02-01 00:00:00")
    assert len(failed.value.errors) == 1 and "2030" in next(iter(failed.value.errors))
    assert [row["model_id"] for row in store.models.read(spark).collect()] == model_keys(spark, [good])


def test_reading_dates_lists_only_their_folders(spark, tmp_path):
    store = Store(str(tmp_path / "dated"))
    store.create(spark)
    table = store.summary
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-09')) AS summary_date")
    for field in table.schema:
        if field.name != "summary_date":
            days = days.withColumn(field.name, F.lit(None).cast(field.dataType))
    table.replace_partitions(days)
    few = table.read_dates(spark, date(2024, 1, 3), date(2024, 1, 4))
    assert len(few.inputFiles()) == 2 and few.schema == table.read(spark).schema
    assert table.read_dates(spark, date(2025, 1, 1), date(2025, 1, 2)).count() == 0


def test_upsert_that_is_cut_short_changes_nothing(spark, tmp_path, monkeypatch):
    table = Store(str(tmp_path / "cut")).summary
    row = spark.createDataFrame([(date(2024, 1, 1), "a")], "summary_date DATE, sensor_id STRING")
    for field in table.schema:
        if field.name not in row.columns:
            row = row.withColumn(field.name, F.lit(None).cast(field.dataType))
    table.replace_partitions(row)

    def broken(*_, **__):
        raise OSError("no space")

    more = row.withColumn("sensor_id", F.lit("b"))
    monkeypatch.setattr(VersionedTable, "commit", broken)
    with pytest.raises(OSError, match="no space"):
        table.upsert(more, ("summary_date", "sensor_id"), F.lit(True))
    monkeypatch.undo()
    assert [r["sensor_id"] for r in table.read(spark).collect()] == ["a"]
    table.upsert(more, ("summary_date", "sensor_id"), F.lit(True))
    assert {r["sensor_id"] for r in table.read(spark).collect()} == {"a", "b"}
