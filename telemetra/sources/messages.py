"""The message source: keyed JSON documents, in batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.functions.keys import row_id
from telemetra.schemas import MESSAGE

# Producers and consumers know the topics by these names.
RAW_TOPIC, PROCESSED_TOPIC, ANOMALY_TOPIC = "raw_data", "processed_data", "anomalies"
FILE_MESSAGE_SCHEMA = "key STRING, value BINARY"


def kafka_source_options(servers: str, topic: str = RAW_TOPIC, starting_offsets: str = "latest") -> dict[str, str]:
    """Options of the Kafka source. Needs the public spark-sql-kafka connector on the class path."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }


def read_message_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """Stream of messages from Kafka, or from parquet files of the same key and value columns.

    ``maxOffsetsPerTrigger`` (Kafka) and ``maxFilesPerTrigger`` (files) bound one micro-batch.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load()
    return reader.schema(FILE_MESSAGE_SCHEMA).load(path)


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Bounded set of message files."""
    return spark.read.schema(FILE_MESSAGE_SCHEMA).format(fmt).load(path)


def _message_id(messages: DataFrame) -> Column:
    """Key of a message: one already given, else its place in the topic, else its content."""
    if "row_id" in messages.columns:
        return F.col("row_id")
    if {"topic", "partition", "offset"} <= set(messages.columns):
        return row_id("topic", "partition", "offset")
    return row_id(F.col("value").cast("string"))


def decode(messages: DataFrame) -> DataFrame:
    """Message key, text and surrogate key."""
    return messages.select(
        _message_id(messages).alias("row_id"),
        F.col("value").cast("string").alias("json_text"),
    )


def parse(messages: DataFrame) -> DataFrame:
    """One row per message with the declared fields; unreadable JSON gives NULL fields.

    Going through ``inline`` keeps later filters above the parse. With a plain struct expansion
    Catalyst pushes them below it and parses the same text once per filtered field.
    """
    return decode(messages).select("row_id", F.inline(F.array(F.from_json("json_text", MESSAGE))))
