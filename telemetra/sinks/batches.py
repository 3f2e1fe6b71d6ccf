"""What a micro-batch is written to. A sink is a function of (batch, batch_id)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.sources.messages import ANOMALY_TOPIC, PROCESSED_TOPIC
from telemetra.tables import Table

Sink = Callable[[DataFrame, int], None]
Shape = Callable[[DataFrame], DataFrame]


def table_sink(table: Table, shape: Shape, rebalance: bool = False) -> Sink:
    """Write into the partitions (event_date, batch_id); a replayed batch replaces itself.

    ``rebalance`` shuffles the batch into few files of even size per date. A date that holds most
    rows is split, so it never ends in one task.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch).withColumns(
            {"event_date": F.to_date("event_time"), "batch_id": F.lit(batch_id).cast("bigint")}
        )
        table.replace_partitions(rows.hint("rebalance", "event_date") if rebalance else rows)

    return write


def message_file_sink(path: str, shape: Shape) -> Sink:
    """Write key and value as files, one folder per batch; a replayed batch replaces its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        messages = shape(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        (
            messages.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return write


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    """Options of the Kafka sink; topics are ``PROCESSED_TOPIC`` and ``ANOMALY_TOPIC``."""
    if topic not in (PROCESSED_TOPIC, ANOMALY_TOPIC):
        raise ValueError(f"unknown topic {topic!r}")
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def kafka_sink(options: dict[str, str], shape: Shape) -> Sink:
    """Send key and value to a topic. A replayed batch is sent again: delivery is at least once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.format("kafka").options(**options).save()

    return write


def jdbc_sink_options(url: str, table: str, batch_size: int = 10_000, connections: int = 32) -> dict[str, str]:
    """Options of the JDBC sink; ``connections`` bounds how many tasks write at a time."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), "numPartitions": str(connections)}


def delete_statement(table: str) -> str:
    """Removes the rows of one batch."""
    return f"DELETE FROM {table} WHERE batch_id = ?"


def delete_batch(spark: SparkSession, options: dict[str, str], batch_id: int, **credentials: str) -> None:
    """Delete a batch's rows over one connection of the driver."""
    jvm = spark._jvm
    if "driver" in credentials:
        jvm.java.lang.Class.forName(credentials["driver"])
    properties = jvm.java.util.Properties()
    for name, value in credentials.items():
        properties.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        statement = connection.prepareStatement(delete_statement(options["dbtable"]))
        statement.setLong(1, batch_id)
        statement.executeUpdate()
    finally:
        connection.close()


def jdbc_sink(options: dict[str, str], shape: Shape, **credentials: str) -> Sink:
    """Write rows over JDBC; user, password and driver class are given by the caller.

    Rows carry row_id and batch_id. The rows of a batch are deleted before it is written, so a replay replaces what an
    earlier try has left.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        delete_batch(batch.sparkSession, options, batch_id, **credentials)
        rows = shape(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rows.write.format("jdbc").mode("append").options(**options, **credentials).save()

    return write


def console_sink(shape: Shape) -> Sink:
    """Print a batch, untruncated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.format("console").option("truncate", False).mode("append").save()

    return write
