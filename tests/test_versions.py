"""Versions of a table, and compacted dates."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from samples import message, messages
from telemetra import versions
from telemetra.compaction import Compacted, Wanted, compact, packed, sweep
from telemetra.functions.times import instant
from telemetra.operators.summary import daily_summary
from telemetra.plans.daily import hourly_summary, run_summary
from telemetra.schemas import SUMMARY_KEYS
from telemetra.sources.scans import remove
from telemetra.streaming.etl import anomalies_shape, hourly_shape, readings_shape, transform
from telemetra.sinks.batches import table_sink
from telemetra.tables import Store
from telemetra.versions import ConcurrentWrite, UnknownVersion, VersionedTable

KIND = "day DATE, key STRING, value INT"


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable("numbers", str(tmp_path / "numbers"), spark.createDataFrame([], KIND).schema, ("day",))


def rows(spark, *values):
    return spark.createDataFrame([(date(2024, 5, day), key, value) for day, key, value in values], KIND)


def content(df):
    return sorted((r.day.day, r.key, r.value) for r in df.collect())


def upsert(spark, table, *values):
    new = rows(spark, *values)
    table.upsert(new, ("day", "key"), F.col("day").isin([date(2024, 5, day) for day, _, _ in values]))


def test_each_write_is_a_version(spark, table):
    assert table.read(spark).count() == 0 and table.versions(spark) == []
    table.replace_partitions(rows(spark, (1, "a", 1), (2, "a", 2)))
    upsert(spark, table, (2, "a", 3), (2, "b", 4))
    table.replace_partitions(rows(spark, (3, "c", 5)))
    assert content(table.read(spark)) == [(1, "a", 1), (2, "a", 3), (2, "b", 4), (3, "c", 5)]
    assert content(table.read(spark, 1)) == [(1, "a", 1), (2, "a", 2)] and table.versions(spark) == [1, 2, 3]
    assert content(table.read_dates(spark, date(2024, 5, 2), date(2024, 5, 9))) == [(2, "a", 3), (2, "b", 4), (3, "c", 5)]
    with pytest.raises(UnknownVersion):
        table.read(spark, 9)


def test_a_reader_keeps_its_version(spark, table):
    table.replace_partitions(rows(spark, (1, "a", 1)))
    before = table.read(spark)
    upsert(spark, table, (1, "a", 2))
    table.replace_partitions(rows(spark, (1, "z", 9)))
    assert content(before) == [(1, "a", 1)] and content(table.read(spark)) == [(1, "z", 9)]


@pytest.mark.parametrize("step", ["write", "switch", "after"])
def test_a_write_that_is_cut_short_leaves_the_old_rows(spark, table, monkeypatch, step):
    upsert(spark, table, (1, "a", 1), (1, "b", 1))
    old = content(table.read(spark))

    def lost(*_, **__):
        raise RuntimeError("lost")

    if step == "write":
        monkeypatch.setattr(VersionedTable, "write_run", lost)
    elif step == "switch":
        monkeypatch.setattr(VersionedTable, "commit", lost)
    else:
        # The new manifest is written, but not yet put in place.
        monkeypatch.setattr(versions, "write_once", lost)
    with pytest.raises(RuntimeError, match="lost"):
        upsert(spark, table, (1, "a", 2))
    monkeypatch.undo()
    assert content(table.read(spark)) == old
    # What the lost writer has left is not a version's, and goes when it is old enough.
    table.vacuum(spark, abandoned_hours=24)
    folders = list(Path(table.path).glob("data/*/part=*"))
    assert len(folders) == (1 if step == "write" else 2)
    assert len(table.vacuum(spark, abandoned_hours=0)) == len(folders) - 1
    upsert(spark, table, (1, "a", 2))
    assert content(table.read(spark)) == [(1, "a", 2), (1, "b", 1)]


def test_two_writers(spark, table, monkeypatch):
    """A write between another's reading and its switch is merged, not lost."""
    upsert(spark, table, (1, "a", 1), (2, "a", 1))
    write, between = VersionedTable.write_run, []

    def slow(self, df, *rest):
        written = write(self, df, *rest)
        if between:
            upsert(spark, table, *between.pop())
        return written

    monkeypatch.setattr(VersionedTable, "write_run", slow)
    between.append([(1, "b", 2)])
    upsert(spark, table, (1, "a", 9))
    assert content(table.read(spark)) == [(1, "a", 9), (1, "b", 2), (2, "a", 1)]
    # Writers of different partitions don't disturb each other.
    between.append([(2, "b", 3)])
    upsert(spark, table, (1, "c", 4))
    assert content(table.read(spark)) == [(1, "a", 9), (1, "b", 2), (1, "c", 4), (2, "a", 1), (2, "b", 3)]
    between += [[(1, "d", n)] for n in range(20)]
    always = VersionedTable("numbers", table.path, table.schema, ("day",), attempts=2)
    monkeypatch.setattr(VersionedTable, "commit", lambda *_, strict=False, **__: None)
    with pytest.raises(ConcurrentWrite):
        always.upsert(rows(spark, (1, "e", 1)), ("day", "key"), F.col("day") == date(2024, 5, 1))


def test_a_version_is_put_in_place_by_one_writer_only(spark, tmp_path):
    name = str(tmp_path / "versions" / "1.json")
    Path(name).parent.mkdir()
    assert versions.write_once(spark, name, "first") and not versions.write_once(spark, name, "second")
    assert versions.read_text(spark, name) == "first" and versions.children(spark, str(tmp_path / "versions")) == ["1.json"]


def test_vacuum_keeps_what_the_last_versions_need(spark, table):
    for n in range(4):
        table.replace_partitions(rows(spark, (1, "a", n)))
    table.replace_partitions(rows(spark, (2, "b", 7)))
    gone = table.vacuum(spark, keep=2)
    assert len(gone) == 3 and table.versions(spark) == [4, 5]
    assert content(table.read(spark, 4)) == [(1, "a", 3)] and content(table.read(spark)) == [(1, "a", 3), (2, "b", 7)]
    assert table.vacuum(spark, keep=2) == []
    with pytest.raises(ValueError):
        table.vacuum(spark, keep=0)


def test_upsert_of_no_rows(spark, table):
    table.upsert(rows(spark), ("day", "key"), F.lit(False))
    assert table.versions(spark) == [] and table.read(spark).count() == 0


# --- compaction

START = datetime(2024, 3, 1)


@pytest.fixture
def store(spark, tmp_path):
    """Three dates in six batches; every date is in several of them."""
    store = Store(str(tmp_path / "with space"))
    store.create(spark)
    for number in range(6):
        ingest(spark, store, number, [body(h, "abcdef"[(h + k) % 6], k) for k, h in enumerate(range(number, 72, 6))])
    return store


def body(hours, sensor, k=0):
    return message(sensor_id=sensor, timestamp=(START + timedelta(hours=hours, minutes=k)).isoformat(), pm2_5=float(hours))


def ingest(spark, store, number, bodies):
    batch = transform(messages(spark, bodies).withColumn("row_id", F.col("row_id") + 1000 * number), instant(START))
    for table, shape in ((store.readings, readings_shape), (store.anomalies, anomalies_shape), (store.hourly, hourly_shape)):
        table_sink(table, shape)(batch, number)


def whole(df):
    return sorted(map(str, df.collect()))


def test_same_rows_before_and_after(spark, store):
    readings = store.readings
    before, dates = whole(readings.read(spark)), whole(readings.read_dates(spark, date(2024, 3, 2), date(2024, 3, 3)))
    pinned = readings.read(spark)
    assert compact(spark, readings, date(2024, 3, 3)) == ["2024-03-01", "2024-03-02"]
    for _ in range(2):
        assert whole(readings.read(spark)) == before
        assert whole(readings.read_dates(spark, date(2024, 3, 2), date(2024, 3, 3))) == dates
        assert whole(readings.read_dates(spark, date(2024, 3, 1))) == before
        if pinned is not None:
            # Readers that began before see their folders until the sweep.
            assert whole(pinned) == before
            pinned = None
            assert len(sweep(spark, readings)) == 12
    assert compact(spark, readings, date(2024, 3, 3)) == [] and sweep(spark, readings) == []
    assert len(list(Path(readings.path).glob("event_date=2024-03-03/batch_id=*"))) == 6
    assert [tuple(r) for r in readings.read(spark).groupBy("batch_id").count().orderBy("batch_id").collect()] == [(n, 12) for n in range(6)]


def test_late_batches_of_a_compacted_date(spark, store):
    readings = store.readings
    compact(spark, readings, date(2024, 3, 2))
    late = [body(5, "late"), body(71, "a", 59)]
    ingest(spark, store, 6, late)
    assert readings.read(spark).count() == 74
    assert readings.read_window(spark, START, START + timedelta(hours=24), "late").count() == 1
    # A batch that is replayed after it was compacted is not read twice.
    ingest(spark, store, 0, [body(h, "abcdef"[(h + k) % 6], k) for k, h in enumerate(range(0, 72, 6))])
    assert readings.read(spark).count() == 74
    assert compact(spark, readings, date(2024, 3, 2)) == ["2024-03-01"]
    sweep(spark, readings)
    assert readings.read(spark).count() == 74 and readings.read_dates(spark, date(2024, 3, 1), date(2024, 3, 1)).count() == 25
    assert not list(Path(readings.path).glob("event_date=2024-03-01/*/*.parquet"))
    # Limits and files of the first compaction are gone with their version.
    assert len(list(Path(readings.path).glob("_compacted/limits/*"))) == 1


def test_a_narrow_read_opens_only_files_that_may_hold_its_rows(spark, store):
    readings = store.readings
    expected = readings.read(spark)
    compact(spark, readings, date(2024, 3, 4), file_bytes=3_000)
    files = set(readings.read(spark).inputFiles())
    assert len(files) > 8
    for sensor, hour in (("a", 6), ("c", 30), ("f", 71), ("nobody", 3)):
        start, end = START + timedelta(hours=hour), START + timedelta(hours=hour + 1)
        found = readings.read_window(spark, start, end, sensor)
        wanted = expected.filter((F.col("sensor_id") == sensor) & (F.col("event_time") >= instant(start)) & (F.col("event_time") < instant(end)))
        assert whole(found) == whole(wanted)
        opened = found.inputFiles()
        limits = spark.read.parquet(*map(str, Path(readings.path).glob("_compacted/limits/*")))
        inside = limits.filter(Wanted(sensor, start, end).of_files()).select("file").collect()
        assert sorted(name.rsplit("/", 1)[1] for name in opened) == sorted(r.file for r in inside) and len(opened) <= 3 < len(files)
    assert whole(readings.read_window(spark, START, START + timedelta(days=9))) == whole(expected)


def test_limits_hold(spark, store):
    compact(spark, store.readings, date(2024, 3, 4), file_bytes=4_000)
    limits = {(r.folder.rsplit("=", 1)[1], r.file): r for r in spark.read.parquet(*map(str, Path(store.readings.path).glob("_compacted/limits/*"))).collect()}
    found = store.readings.read(spark).select("event_date", F.col("_metadata.file_name").alias("file"), "event_time", "sensor_id").collect()
    assert {(str(r.event_date), r.file) for r in found} == set(limits) and sum(r.n_rows for r in limits.values()) == len(found)
    for r in found:
        of = limits[str(r.event_date), r.file]
        assert of.first_time <= r.event_time <= of.last_time and of.first_sensor <= r.sensor_id <= of.last_sensor


def test_a_compaction_that_is_cut_short_changes_nothing(spark, store, monkeypatch):
    before = whole(store.readings.read(spark))

    def lost(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(VersionedTable, "commit", lost)
    with pytest.raises(RuntimeError, match="lost"):
        compact(spark, store.readings, date(2024, 3, 3))
    monkeypatch.undo()
    assert whole(store.readings.read(spark)) == before and sweep(spark, store.readings) == []
    # Of two compactions at a time the second one to end gives up its files.
    monkeypatch.setattr(VersionedTable, "commit", lambda *_, **__: None)
    assert compact(spark, store.readings, date(2024, 3, 3)) == []
    monkeypatch.undo()
    assert whole(store.readings.read(spark)) == before and compact(spark, store.readings, date(2024, 3, 3)) != []


def test_jobs_and_summaries_see_the_same(spark, store):
    as_of = "2024-03-02 06:30:00"
    wanted = daily_summary(store.readings.read(spark), store.anomalies.read(spark), as_of).collect()
    for table in (store.readings, store.anomalies, store.hourly):
        compact(spark, table, date(2024, 3, 4))
        sweep(spark, table)
    assert sorted(hourly_summary(spark, store, as_of).collect()) == sorted(wanted)
    assert len(run_summary(spark, store, as_of).collect()) == len(wanted) == 6
    store.readings.register(spark)
    assert spark.sql("SELECT COUNT(*) AS n FROM sensor_readings").first().n == 72
    spark.catalog.dropTempView("sensor_readings")


def test_rows_without_a_time_stay(spark, store):
    ingest(spark, store, 9, [message(timestamp="soon"), body(1, "a")])
    before = whole(store.readings.read(spark))
    compact(spark, store.readings, date(2024, 3, 4))
    sweep(spark, store.readings)
    assert whole(store.readings.read(spark)) == before and len(before) == 74


def test_dates_are_packed_by_size():
    sizes = {"d1": 60, "d2": 50, "d3": 40, "d4": 300, "d5": 10, "d6": 0}
    jobs = packed(sizes, 100)
    assert sorted(day for job in jobs for day in job) == sorted(sizes)
    assert all(sum(sizes[day] for day in job) <= 100 or len(job) == 1 for job in jobs) and len(jobs) == 3
    assert packed({}, 100) == []


def test_tables_that_were_never_compacted(spark, tmp_path):
    store = Store(str(tmp_path))
    store.create(spark)
    assert compact(spark, store.readings, date(2024, 3, 3)) == [] and sweep(spark, store.readings) == []
    assert store.readings.read(spark).count() == 0 and store.readings.read_dates(spark, date(2024, 3, 1)).count() == 0
    assert not Compacted(store.readings.path, store.readings.schema).table.versions(spark)
    remove(spark, str(tmp_path))


def test_summary_rows_are_unique_whoever_writes(spark, store):
    run_summary(spark, store, "2024-03-02 00:00:00")
    run_summary(spark, store, "2024-03-02 12:00:00")
    found = store.summary.read(spark)
    assert found.count() == found.select(*SUMMARY_KEYS).distinct().count() == 6
