from __future__ import annotations

from unittest.mock import MagicMock

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from samples import GOOD, message, messages
from telemetra.functions.times import instant
from telemetra.operators.clean import clean
from telemetra.operators.enrich import debug_projection, enrich, flatten_readings
from telemetra.queries import fixture
from telemetra.sinks.batches import (
    console_sink,
    jdbc_sink,
    jdbc_sink_options,
    kafka_sink,
    kafka_sink_options,
    message_file_sink,
    table_sink,
)
from telemetra.sources.messages import kafka_source_options, read_message_stream, read_messages
from telemetra.sources.scans import jdbc_scan_options
from telemetra.streaming.etl import (
    anomalies_shape,
    await_any,
    file_sinks,
    processed_messages,
    readings_shape,
    run_debug,
    run_etl,
    transform,
)
from telemetra.tables import Store

AS_OF = "2024-01-15 00:00:00"


@pytest.fixture
def landed(spark, sf_small, tmp_path):
    """Message files, the same rows as a batch, and an empty store."""
    path = str(tmp_path / "landing")
    rows = fixture.messages(spark, sf_small).drop("row_id")
    rows.repartition(4).write.parquet(path)
    store = Store(str(tmp_path / "store"))
    store.create(spark)
    return path, store, str(tmp_path)


def ids(df):
    return sorted(row["row_id"] for row in df.select("row_id").collect())


def run(spark, path, sinks, checkpoint):
    stream = read_message_stream(spark, "parquet", path, maxFilesPerTrigger="1")
    query = run_etl(stream, sinks, checkpoint, processed_at=instant(AS_OF))
    query.awaitTermination()
    return query


def test_stream_equals_batch_in_all_sinks(spark, landed):
    path, store, root = landed
    query = run(spark, path, file_sinks(store, f"{root}/messages"), f"{root}/checkpoint")
    assert query.lastProgress["batchId"] >= 3
    batch = transform(read_messages(spark, path), instant(AS_OF))
    readings, anomalies = store.readings.read(spark), store.anomalies.read(spark)
    wanted = readings_shape(batch)
    stored = readings.select(*wanted.columns)
    assert stored.exceptAll(wanted).isEmpty() and wanted.exceptAll(stored).isEmpty()
    assert readings.count() == 888 and anomalies.count() == 183
    assert ids(anomalies) == ids(anomalies_shape(batch))
    processed = spark.read.parquet(f"{root}/messages/processed_data")
    alerts = spark.read.parquet(f"{root}/messages/anomalies")
    assert processed.count() == 888 and alerts.count() == 183
    expected = processed_messages(batch)
    assert processed.select("key", "value").exceptAll(expected).isEmpty()


def test_restart_takes_up_only_new_files(spark, landed, sf_small):
    path, store, root = landed
    sinks = file_sinks(store)
    run(spark, path, sinks, f"{root}/checkpoint")
    run(spark, path, sinks, f"{root}/checkpoint")
    assert store.readings.read(spark).count() == 888
    messages(spark, [message(), message(sensor_id="b")]).drop("row_id").write.mode("append").parquet(path)
    run(spark, path, sinks, f"{root}/checkpoint")
    assert store.readings.read(spark).count() == 890


def test_replayed_batch_replaces_itself(spark, landed):
    """A batch that failed half way is run again with the same number."""
    path, store, root = landed
    sinks = [*file_sinks(store), message_file_sink(f"{root}/out", processed_messages)]
    failures = []

    def fail_once(batch, batch_id):
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        run(spark, path, [*sinks, fail_once], f"{root}/checkpoint")
    assert failures and store.readings.read(spark).count() > 0
    run(spark, path, [*sinks, fail_once], f"{root}/checkpoint")
    readings = store.readings.read(spark)
    assert readings.count() == 888 and store.anomalies.read(spark).count() == 183
    assert spark.read.parquet(f"{root}/out").count() == 888


def test_rebalanced_write_has_the_same_rows(spark, landed):
    path, store, root = landed
    run(spark, path, file_sinks(store, rebalance=True), f"{root}/checkpoint")
    assert store.readings.read(spark).count() == 888


def test_rebalance_splits_a_hot_date(spark, tmp_path):
    """All rows on one date must not end in one task."""
    store = Store(str(tmp_path))
    store.readings.create(spark)
    many = messages(spark, [message()]).select("key", "value", F.explode(F.sequence(F.lit(1), F.lit(20_000))).alias("row_id"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        batch = transform(many.repartition(4), instant(AS_OF))
        table_sink(store.readings, readings_shape, rebalance=True)(batch, 0)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    date = GOOD["timestamp"][:10]
    assert len(list(tmp_path.rglob(f"event_date={date}/*/*.parquet"))) > 1
    assert store.readings.read(spark).count() == 20_000


def test_outside_sinks_send_what_they_should(spark):
    """Brokers and databases are not started here; only the calls to the writer are checked."""
    sent = MagicMock()
    kafka_sink(kafka_sink_options("broker:9092", "anomalies"), lambda batch: sent)(None, 0)
    sent.write.format.assert_called_once_with("kafka")
    assert sent.write.format().options.call_args.kwargs["topic"] == "anomalies"
    stored = MagicMock()
    session = MagicMock()
    connection = session._jvm.java.sql.DriverManager.getConnection.return_value
    batch = MagicMock(sparkSession=session)
    jdbc_sink(jdbc_sink_options("jdbc:x", "sensor_readings"), lambda batch: stored, user="u")(batch, 3)
    connection.prepareStatement.assert_called_once_with("DELETE FROM sensor_readings WHERE batch_id = ?")
    connection.prepareStatement().setLong.assert_called_once_with(1, 3)
    connection.close.assert_called_once()
    assert stored.withColumn.call_args.args[0] == "batch_id"
    writer = stored.withColumn().write
    writer.format.assert_called_once_with("jdbc")
    writer.format().mode.assert_called_once_with("append")
    assert writer.format().mode().options.call_args.kwargs["user"] == "u"


def test_console_sink_accepts_a_batch(spark):
    """The text goes to the standard output of the JVM, out of reach of the test."""
    batch = transform(messages(spark, [message()]), instant(AS_OF))
    console_sink(debug_projection)(batch, 0)


def test_readings_without_time_are_stored(spark, tmp_path):
    store = Store(str(tmp_path))
    store.readings.create(spark)
    batch = transform(messages(spark, [message(timestamp="garbage"), message()]), instant(AS_OF))
    table_sink(store.readings, readings_shape)(batch, 0)
    assert store.readings.read(spark).filter("event_time IS NULL AND event_date IS NULL").count() == 1


def test_debug_query(spark, landed):
    path, _, root = landed
    stream = read_message_stream(spark, "parquet", path)
    run_debug(stream, f"{root}/debug", fmt="memory", name="debug_rows").awaitTermination()
    assert spark.table("debug_rows").count() == 888


def test_waiting_for_any_query(spark, landed):
    path, store, root = landed
    spark.streams.resetTerminated()
    stream = read_message_stream(spark, "parquet", path)
    query = run_etl(stream, file_sinks(store), f"{root}/c", trigger={"processingTime": "1 second"})
    assert await_any(spark, timeout=1) is False
    query.processAllAvailable()
    query.stop()
    assert await_any(spark, timeout=30) is True
    assert store.readings.read(spark).count() == 888


def test_stream_plan_parses_once(spark, landed):
    path, _, root = landed
    stream = read_message_stream(spark, "parquet", path)
    rows = flatten_readings(transform(stream)).writeStream.format("memory").queryName("plan_rows")
    query = rows.option("checkpointLocation", f"{root}/plan").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query._jsq.explainInternal(False).count("from_json") == 1


def test_stream_ids_are_stable(spark, landed):
    path, _, _ = landed
    first = ids(transform(read_messages(spark, path)))
    assert first == ids(transform(read_messages(spark, path).repartition(7)))


def test_clean_accepts_both_shapes(spark, sf_small):
    flat_rows = enrich(clean(fixture.raw(spark, sf_small)), instant(AS_OF))
    nested_rows = enrich(clean(fixture.parsed(spark, sf_small)), instant(AS_OF))
    left = flatten_readings(flat_rows, carry=("row_id",))
    right = flatten_readings(nested_rows, carry=("row_id",))
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_kafka_options(spark):
    assert kafka_source_options("broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "raw_data", "startingOffsets": "latest",
    }
    assert kafka_sink_options("broker:9092", "anomalies")["topic"] == "anomalies"
    with pytest.raises(ValueError):
        kafka_sink_options("broker:9092", "other")


def test_kafka_needs_its_connector(spark):
    """The connector is not part of this image; the error must name what is missing."""
    with pytest.raises(AnalysisException, match="kafka"):
        read_message_stream(spark, **kafka_source_options("broker:9092"))


def test_jdbc_options():
    scan = jdbc_scan_options("jdbc:x", "sensor_readings", "event_time", "2024-01-01", "2024-02-01", 64)
    assert scan["partitionColumn"] == "event_time" and scan["numPartitions"] == "64"
    assert jdbc_sink_options("jdbc:x", "sensor_readings")["dbtable"] == "sensor_readings"


def test_null_key_messages_do_not_stop_the_stream(spark, tmp_path):
    path = str(tmp_path / "landing")
    messages(spark, [None, "", "hello", message()]).drop("row_id").write.parquet(path)
    store = Store(str(tmp_path / "store"))
    store.create(spark)
    run(spark, path, file_sinks(store), str(tmp_path / "checkpoint"))
    assert store.readings.read(spark).select(F.count("*")).first()[0] == 1
