"""Streams with state: messages sent twice, summaries by sliding window; and statistics by hour."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from samples import flat, message, messages
from telemetra.functions.times import instant
from telemetra.operators.clean import clean
from telemetra.operators.enrich import flatten_readings
from telemetra.operators.partials import hourly_partials, merge_partials, summary_from_partials, with_statistics
from telemetra.operators.summary import daily_summary, sensor_stats
from telemetra.operators.enrich import detect, flatten_anomalies
from telemetra.plans.daily import hourly_summary, rebuild_hours, run_summary
from telemetra.queries import fixture
from telemetra.sinks.batches import table_sink
from telemetra.sources.messages import parse, read_message_stream
from telemetra.streaming.duplicates import drop_repeats
from telemetra.streaming.etl import file_sinks, hourly_shape, readings_shape, run_etl, transform
from telemetra.streaming.rolling import rolling_summary
from telemetra.tables import Store

START = datetime(2024, 3, 1)


def at(hours, sensor="a", **changes):
    return message(sensor_id=sensor, timestamp=(START + timedelta(hours=hours)).isoformat(), **changes)


def land(spark, path, bodies):
    """One more file of messages; the stream reads files in the order of their times."""
    messages(spark, bodies).select("key", "value").coalesce(1).write.mode("append").parquet(path)


def arriving(spark, path):
    return read_message_stream(spark, "parquet", path, maxFilesPerTrigger="1")


def once(spark, path, root, delay="2 hours"):
    """Work off the files with repeats dropped; (sensor, time) of what is kept, and the query."""
    kept = drop_repeats(parse(arriving(spark, path)), delay).select("sensor_id", "timestamp")
    sink = kept.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    query = sink.start(f"{root}/kept")
    query.awaitTermination()
    rows = spark.read.schema(kept.schema).parquet(f"{root}/kept").collect()
    return sorted(((r.sensor_id, r.timestamp) for r in rows), key=str), query


def expected(*bodies):
    return sorted(((body["sensor_id"], body["timestamp"]) for body in bodies), key=str)


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path):
    path = str(tmp_path / "landing")
    a, b, c = at(0), at(0, "b"), at(1)
    land(spark, path, [a, a, b])
    land(spark, path, [c, a, at(1, pm2_5=99.0)])
    kept, _ = once(spark, path, str(tmp_path))
    assert kept == expected(a, b, c)
    # The same after a restart: what was seen is in the checkpoint.
    land(spark, path, [b, c, at(2)])
    assert once(spark, path, str(tmp_path))[0] == expected(a, b, c, at(2))


def test_state_is_forgotten_and_late_messages_are_dropped(spark, tmp_path):
    path, root = str(tmp_path / "landing"), str(tmp_path)
    sizes = []
    for day in range(5):
        land(spark, path, [at(24 * day + minute / 60) for minute in range(50)])
        _, query = once(spark, path, root)
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    # Each day's 50 keys go when the next day moves the watermark: state does not grow with the stream.
    assert max(sizes) <= 50
    # Later than the watermark (two hours before the last event): dropped, whether seen before or not.
    land(spark, path, [at(0), at(90), at(96.51)])
    kept, _ = once(spark, path, root)
    assert len(kept) == 251 and (START + timedelta(hours=90)).isoformat() not in {time for _, time in kept}


def test_messages_without_a_readable_time_all_stay(spark, tmp_path):
    path = str(tmp_path / "landing")
    bad = message(timestamp="soon")
    land(spark, path, [bad, {**bad, "status": "other"}, at(0)])
    land(spark, path, [at(0), message(timestamp=None)])
    kept, query = once(spark, path, str(tmp_path))
    assert kept == expected(bad, bad, at(0), {**bad, "timestamp": None})
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 1


def test_repeats_in_a_batch(spark):
    rows = parse(messages(spark, [at(0), at(0), at(1), message(timestamp="soon"), message(timestamp="soon")]))
    assert drop_repeats(rows, "1 hour").count() == 4


def test_etl_counts_a_replayed_topic_once(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    store.create(spark)
    path = str(tmp_path / "landing")
    for _ in range(2):
        land(spark, path, [at(h / 4) for h in range(40)])
    etl = run_etl(arriving(spark, path), file_sinks(store, hourly=True), str(tmp_path / "checkpoint"), processed_at=instant(START), once_within="1 day")
    etl.awaitTermination()
    assert store.readings.read(spark).count() == 40
    assert store.hourly.read(spark).agg(F.sum("n")).first()[0] == 40


# --- summaries by sliding window


def rolled(spark, path, root, delay="1 hour"):
    windows = rolling_summary(transform(arriving(spark, path), instant(START)), delay)
    sink = windows.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
    query = sink.trigger(availableNow=True).start(f"{root}/windows")
    query.awaitTermination()
    rows = spark.read.schema(windows.schema).parquet(f"{root}/windows").collect()
    return {(r.sensor_id, r.as_of): r for r in rows}, query


def test_windows_and_late_readings(spark, tmp_path):
    path, root = str(tmp_path / "landing"), str(tmp_path)
    land(spark, path, [at(h, pm2_5=10.0) for h in (0, 1, 2, 3)])
    # Half an hour late: hour 3 is still open, so its windows change.
    land(spark, path, [at(3.5, pm2_5=40.0), at(3.4, pm2_5=40.0)])
    land(spark, path, [at(30, pm2_5=10.0)])
    # An hour is closed by the batch after the one that moved the watermark past it.
    land(spark, path, [at(30.1, pm2_5=10.0)])
    # A day late: its hour is closed, and no window changes.
    land(spark, path, [at(2, pm2_5=500.0), at(60)])
    found, query = rolled(spark, path, root)
    end = lambda hours: START + timedelta(hours=hours)
    first = found["a", end(1)]
    assert (first.total_readings, first.avg_pm2_5, first.dominant_aqi) == (1, 10.0, "good")
    fourth = found["a", end(4)]
    assert (fourth.total_readings, fourth.avg_pm2_5, fourth.max_pm2_5, fourth.anomaly_count) == (6, 20.0, 40.0, 2)
    assert found["a", end(24)].total_readings == 6 and found["a", end(25)].total_readings == 5
    assert found["a", end(27)].total_readings == 3 and ("a", end(29)) not in found
    # Only what the watermark has passed is sent: the last event is at hour 60.
    assert max(as_of for _, as_of in found) <= end(59)
    state = query.lastProgress["stateOperators"]
    assert sum(op["numRowsTotal"] for op in state) <= 24 + 2 + 24


def test_windows_equal_the_daily_summary(spark, tmp_path, sf_small):
    path, root = str(tmp_path / "landing"), str(tmp_path)
    rows = fixture.messages(spark, sf_small).select("key", "value")
    rows.coalesce(1).write.parquet(path)
    found, _ = rolled(spark, path, root)
    readings, anomalies = fixture.readings(spark, sf_small), fixture.anomalies(spark, sf_small)
    for as_of in ("2024-01-10 07:00:00", "2024-01-15 00:00:00"):
        summary = daily_summary(readings, anomalies, as_of).drop("summary_date", "created_at")
        wanted = {tuple(r) for r in summary.collect()}
        when = datetime.fromisoformat(as_of)
        assert {tuple(r[name] for name in summary.columns) for (_, end), r in found.items() if end == when} == wanted != set()


# --- statistics by hour


@pytest.fixture
def some(spark):
    rows = [
        {"event_time": START + timedelta(minutes=7 * i), "sensor_id": "abc"[i % 3], "pm2_5": float(i % 70), "no2": None if i % 5 else 90.0}
        for i in range(600)
    ]
    rows += [{"event_time": None}, {"event_time": START, "sensor_id": "n", "no2": None, "aqi_category": None}]
    return flat(spark, rows).withColumn("heat_index", F.lit(1.0))


def test_partials_add_up(spark, some):
    whole = with_statistics(merge_partials(hourly_partials(some), "sensor_id"))
    stats = sensor_stats(some.filter("event_time is not null"))
    names = [name for name in stats.columns]
    rounded = lambda df: {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(names).collect()}
    assert rounded(whole) == rounded(stats)
    assert {r.sensor_id: r.dominant_aqi for r in whole.collect()}["n"] is None
    # However readings are dealt to batches, and merged in whatever steps.
    parts = [hourly_partials(some.filter(F.col("row_id") % 4 == k)) for k in range(4)]
    union = parts[0].unionByName(parts[1]).unionByName(merge_partials(parts[2].unionByName(parts[3]), "sensor_id", "event_time"))
    assert rounded(with_statistics(merge_partials(union, "sensor_id"))) == rounded(stats)


@pytest.mark.parametrize("as_of", ["2024-03-02 00:00:00", "2024-03-02 11:30:00", "2024-03-02 11:59:59.999999", "2024-03-03 01:00:00.000001", "2024-05-01 00:00:00"])
def test_summary_from_partials_equals_the_summary_of_readings(spark, some, as_of):
    some = some.withColumn("lat", F.lit(1.0))
    wanted = daily_summary(some, detect(some), as_of)
    found = summary_from_partials(hourly_partials(some), as_of, some)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in wanted.collect()}


def test_late_rows_correct_a_stored_hour(spark, tmp_path):
    """A later batch adds its part to an hour; a replay replaces it; only the batch's own readings are read."""
    store = Store(str(tmp_path))
    store.create(spark)
    sinks = [table_sink(store.readings, readings_shape), table_sink(store.hourly, hourly_shape), file_sinks(store)[1]]

    def batch(number, bodies):
        for sink in sinks:
            sink(transform(messages(spark, bodies).withColumn("row_id", F.col("row_id") + 100 * number), instant(START)), number)

    as_of = "2024-03-02 00:00:00"
    batch(0, [at(h / 2, pm2_5=10.0) for h in range(40)])
    before = hourly_summary(spark, store, as_of).first()
    batch(1, [at(3.1, pm2_5=400.0), at(30)])
    for _ in range(2):
        batch(1, [at(3.1, pm2_5=400.0), at(30)])
        after = hourly_summary(spark, store, as_of).first()
        assert (before.total_readings, after.total_readings, after.max_pm2_5) == (40, 41, 400.0)
    read = daily_summary(store.readings.read(spark), store.anomalies.read(spark), as_of).first()
    assert after == read
    report = run_summary(spark, store, as_of, from_hours=True).collect()
    assert [(r.total_readings, r.anomaly_count) for r in report] == [(41, 1)]
    # Lost or never written statistics are built again from the readings.
    store.hourly.replace_partitions(store.hourly.read(spark).withColumn("n", F.lit(0).cast("long")))
    rebuild_hours(spark, store, date(2024, 3, 1), date(2024, 3, 2))
    assert hourly_summary(spark, store, as_of).first() == read


def test_stored_schema_of_partials(spark, some):
    from telemetra.schemas import HOURLY

    found = hourly_partials(some).select(HOURLY.names)
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in HOURLY]
