from __future__ import annotations

from datetime import date, datetime
from pathlib import Path
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from samples import flat
from telemetra import schemas
from telemetra.functions.times import instant
from telemetra.operators.summary import daily_summary
from telemetra.session import NoSharedFolder, workspace
from telemetra.sources.scans import load_staged, materialise, stage_file
from telemetra.tables import Store

AS_OF = "2024-01-15 00:00:00"


def test_create_is_idempotent_and_keeps_rows(spark, tmp_path):
    store = Store(str(tmp_path))
    store.create(spark)
    for table in store.tables():
        assert table.read(spark).count() == 0
        kinds = {field.name: field.dataType for field in table.read(spark).schema}
        assert kinds == {field.name: field.dataType for field in table.schema}
    rows = flat(spark, [{}])
    store.summary.replace_partitions(daily_summary(rows, rows, AS_OF))
    store.create(spark)
    assert store.summary.read(spark).count() == 1


def test_tables_are_known_to_sql(spark, tmp_path):
    store = Store(str(tmp_path))
    store.create(spark)
    rows = flat(spark, [{}])
    store.summary.replace_partitions(daily_summary(rows, rows, AS_OF))
    try:
        for _ in range(2):
            store.summary.register(spark)
            store.promotions.register(spark)
        found = spark.sql("SELECT sensor_id, summary_date FROM sensor_daily_summary").first()
        assert tuple(found) == ("a", date(2024, 1, 15))
        spark.sql("INSERT INTO promotions (model_id, promoted_at) SELECT 'm', TIMESTAMP '2024-01-16 00:00:00'")
        assert store.promotions.read(spark).count() == 1
    finally:
        spark.sql("DROP TABLE IF EXISTS promotions")
        spark.catalog.dropTempView("sensor_daily_summary")


def test_summary_rerun_overwrites_and_keeps_missing_sensors(spark, tmp_path):
    store = Store(str(tmp_path))
    store.create(spark)

    def run(names, as_of, pm2_5):
        rows = flat(spark, [{"sensor_id": n, "pm2_5": pm2_5, "event_time": datetime(2024, 1, 14, 0, 30)} for n in names])
        store.upsert_summary(daily_summary(rows, rows, as_of), F.to_date(instant(as_of)))

    run("ab", "2024-01-13 01:00:00", 1.0)
    run("ab", "2024-01-14 01:00:00", 5.0)
    run("bc", "2024-01-14 13:00:00", 7.0)
    found = {row["sensor_id"]: row for row in store.summary.read(spark).collect()}
    assert {name: row["avg_pm2_5"] for name, row in found.items()} == {"a": 5.0, "b": 7.0, "c": 7.0}
    assert found["a"]["created_at"] == datetime(2024, 1, 14, 1) and found["b"]["created_at"] == datetime(2024, 1, 14, 13)


def test_upsert_leaves_other_partitions_alone(spark, tmp_path):
    store = Store(str(tmp_path))
    store.create(spark)
    rows = flat(spark, [{}])
    first = daily_summary(rows, rows, AS_OF)
    store.summary.replace_partitions(first.withColumn("summary_date", F.lit(date(2024, 1, 1))))
    files = {str(path) for path in tmp_path.rglob("part=2024-01-01/*.parquet")}
    assert files
    store.upsert_summary(first, F.to_date(instant(AS_OF)))
    assert files == {str(path) for path in tmp_path.rglob("part=2024-01-01/*.parquet")}
    assert store.summary.read(spark).count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_staged_files_come_back_equal(spark, tmp_path, fmt):
    rows = flat(spark, [{"pm2_5": 0.1 + 0.2}, {"o3": None}, {"humidity": None}])
    features = rows.select("row_id", *schemas.FEATURES)
    path = stage_file(features, str(tmp_path / fmt), fmt)
    back = load_staged(spark, path, features.schema, fmt)
    assert back.schema.names == features.schema.names
    assert sorted(map(str, back.collect())) == sorted(map(str, features.collect()))


def test_materialised_rows_are_computed_once(spark):
    random = spark.range(100).select(F.rand().alias("x"))
    stage = materialise(random, "test")
    assert stage.rows.collect() == stage.rows.collect() and stage.rows.count() == 100
    stage.discard()
    assert not Path(stage.path).exists()


def test_workspace_is_below_the_named_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = workspace(spark, "x"), workspace(spark, "x")
    assert first.startswith(f"{root}/telemetra/x-") and first != second


def test_a_folder_of_one_machine_is_not_shared(spark):
    """Without a named folder only a session of one process may use its local warehouse."""

    def session(**settings):
        conf = MagicMock()
        conf.get.side_effect = lambda key, *default: settings.get(key.rsplit(".", 1)[-1] if key != "spark.sql.warehouse.dir" else "warehouse", *default)
        return MagicMock(conf=conf)

    assert workspace(session(dir="hdfs://x/c", warehouse="file:/w", master="yarn"), "n").startswith("hdfs://x/c/telemetra/n-")
    assert workspace(session(warehouse="hdfs://x/w", master="yarn"), "n").startswith("hdfs://x/w/_intermediate/telemetra/n-")
    assert workspace(session(warehouse="file:/w", master="local[8]"), "n").startswith("file:/w/_intermediate/")
    for master in ("yarn", "local-cluster[3,2,1024]", "spark://host:7077"):
        with pytest.raises(NoSharedFolder):
            workspace(session(warehouse="file:/w", master=master), "n")
