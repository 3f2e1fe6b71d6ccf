"""Sensor and time stay unique, whatever batch a message comes in."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from samples import message, messages
from telemetra.functions.times import instant
from telemetra.operators.upsert import assert_unique
from telemetra.sinks.unique import Guard
from telemetra.streaming.etl import readings_shape, transform
from telemetra.tables import Store, Table

START = datetime(2024, 3, 1)
KEYS = ("sensor_id", "event_time")


def body(hours, sensor="a", **changes):
    return message(sensor_id=sensor, timestamp=(START + timedelta(hours=hours)).isoformat(), **changes)


@pytest.fixture
def store(spark, tmp_path):
    store = Store(str(tmp_path))
    store.create(spark)
    return store


def append(spark, guard, number, bodies):
    rows = messages(spark, bodies).withColumn("row_id", F.col("row_id") + 1000 * number)
    guard.sink(readings_shape)(transform(rows, instant(START)), number)


def stored(spark, store):
    return sorted((r.sensor_id, (r.event_time - START).total_seconds() / 3600, r.batch_id) for r in store.readings.read(spark).filter("event_time IS NOT NULL").collect())


def test_a_message_sent_again_is_refused(spark, store):
    guard = Guard(store.readings)
    append(spark, guard, 0, [body(0), body(1), body(1, pm2_5=99.0), body(1, "b")])
    append(spark, guard, 1, [body(1), body(2), body(30), body(0, "c")])
    append(spark, guard, 2, [body(30), body(31), body(1, "b")])
    assert stored(spark, store) == [("a", 0.0, 0), ("a", 1.0, 0), ("a", 2.0, 1), ("a", 30.0, 1), ("a", 31.0, 2), ("b", 1.0, 0), ("c", 0.0, 1)]
    assert_unique(store.readings.read(spark), KEYS)
    # Of two in one batch the first stays.
    assert store.readings.read(spark).filter("pm2_5 = 99.0").isEmpty()


def test_a_replay_replaces_itself(spark, store):
    guard = Guard(store.readings)
    for _ in range(2):
        append(spark, guard, 0, [body(h) for h in range(30)])
        append(spark, guard, 1, [body(h) for h in range(20, 40)])
    assert [row[1:] for row in stored(spark, store)] == [(float(h), int(h >= 30)) for h in range(40)]


@pytest.mark.parametrize("words", [1, 7])
def test_full_filters_refuse_nothing_new(spark, store, words):
    """With one word for all keys nearly every key may clash; the comparison with stored rows decides."""
    guard = Guard(store.readings, words=words)
    append(spark, guard, 0, [body(h / 10) for h in range(0, 200, 2)])
    bits = guard.filters.read(spark).agg(F.max(F.bit_count("bits"))).first()[0]
    assert bits > 50
    append(spark, guard, 1, [body(h / 10) for h in range(200)])
    assert len(stored(spark, store)) == 200 and sum(row[2] == 1 for row in stored(spark, store)) == 100


def test_only_flagged_dates_are_read(spark, store, monkeypatch):
    guard = Guard(store.readings)
    append(spark, guard, 0, [body(h) for h in range(72)])
    read = []
    original = Table.read_days
    monkeypatch.setattr(Table, "read_days", lambda self, spark, days: read.append([str(day) for day in days]) or original(self, spark, days))
    append(spark, guard, 1, [body(h + 0.5) for h in range(72)])
    assert read == []
    append(spark, guard, 2, [body(25), body(60.25), body(5.25)])
    assert read == [["2024-03-02"]] and len(stored(spark, store)) == 146


def test_rows_without_a_time_all_stay(spark, store):
    guard = Guard(store.readings)
    append(spark, guard, 0, [message(timestamp="soon"), message(timestamp="soon"), body(0)])
    append(spark, guard, 1, [message(timestamp="soon"), body(0)])
    assert store.readings.read(spark).filter("event_time IS NULL").count() == 3 and len(stored(spark, store)) == 1


def test_an_empty_batch(spark, store):
    guard = Guard(store.readings)
    append(spark, guard, 0, [])
    assert store.readings.read(spark).count() == 0


def test_rows_lost_after_their_filter_are_taken_again(spark, store, monkeypatch):
    guard = Guard(store.readings)
    original = Table.replace_partitions

    def lost(self, df):
        if self.name == store.readings.name:
            raise RuntimeError("lost")
        original(self, df)

    monkeypatch.setattr(Table, "replace_partitions", lost)
    with pytest.raises(RuntimeError):
        append(spark, guard, 0, [body(0)])
    monkeypatch.undo()
    append(spark, guard, 0, [body(0)])
    append(spark, guard, 1, [body(0)])
    assert stored(spark, store) == [("a", 0.0, 0)]
