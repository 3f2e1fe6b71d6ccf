"""The streaming ETL: one query reads, parses and enriches once, and feeds every sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from telemetra.operators.clean import clean
from telemetra.operators.enrich import (
    ANOMALY_FIELDS,
    PROCESSED_FIELDS,
    debug_projection,
    detect,
    enrich,
    flatten_anomalies,
    flatten_readings,
    to_messages,
)
from telemetra.operators.partials import hourly_partials
from telemetra.sinks.batches import Sink, message_file_sink, table_sink
from telemetra.sources.messages import ANOMALY_TOPIC, PROCESSED_TOPIC, parse
from telemetra.streaming.duplicates import drop_repeats
from telemetra.tables import Store


def transform(messages: DataFrame, processed_at: Column | None = None, once_within: str | None = None) -> DataFrame:
    """Messages to clean, enriched rows. No shuffle: rows are handled where they are read.

    With ``once_within`` a sensor's message counts once, see ``drop_repeats``, which shuffles by key.
    """
    rows = clean(parse(messages))
    return enrich(rows if once_within is None else drop_repeats(rows, once_within), processed_at)


def readings_shape(enriched: DataFrame) -> DataFrame:
    return flatten_readings(enriched, carry=("row_id",))


def anomalies_shape(enriched: DataFrame) -> DataFrame:
    return flatten_anomalies(detect(enriched), carry=("row_id",))


def hourly_shape(enriched: DataFrame) -> DataFrame:
    return hourly_partials(flatten_readings(enriched))


def processed_messages(enriched: DataFrame) -> DataFrame:
    return to_messages(enriched, PROCESSED_FIELDS)


def anomaly_messages(enriched: DataFrame) -> DataFrame:
    return to_messages(detect(enriched), ANOMALY_FIELDS)


def file_sinks(
    store: Store, message_root: str | None = None, rebalance: bool = False, hourly: bool = False
) -> list[Sink]:
    """Readings and anomalies as tables and, with ``message_root``, both kinds of message as files.

    ``hourly`` adds each batch's statistics by sensor and hour, from which summaries follow without a look at readings.
    """
    sinks = [
        table_sink(store.readings, readings_shape, rebalance),
        table_sink(store.anomalies, anomalies_shape, rebalance),
    ]
    if hourly:
        sinks.append(table_sink(store.hourly, hourly_shape))
    if message_root is not None:
        sinks += [
            message_file_sink(f"{message_root}/{PROCESSED_TOPIC}", processed_messages),
            message_file_sink(f"{message_root}/{ANOMALY_TOPIC}", anomaly_messages),
        ]
    return sinks


def fan_out(sinks: Sequence[Sink]) -> Sink:
    """All sinks in one batch function; the batch is computed once and read by each of them."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shared = len(sinks) > 1
        if shared:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            if shared:
                batch.unpersist()

    return write


def run_etl(
    messages: DataFrame,
    sinks: Sequence[Sink],
    checkpoint: str,
    trigger: dict | None = None,
    processed_at: Column | None = None,
    once_within: str | None = None,
) -> StreamingQuery:
    """Start the ETL. The default trigger is ``availableNow``: work off what is there, then stop.

    A service passes ``{"processingTime": "1 minute"}`` and then waits with ``await_any``.
    """
    return (
        transform(messages, processed_at, once_within)
        .writeStream.foreachBatch(fan_out(sinks))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_debug(
    messages: DataFrame, checkpoint: str, fmt: str = "console", name: str = "debug", trigger: dict | None = None
) -> StreamingQuery:
    """Separate query that shows the debug columns, untruncated."""
    return (
        debug_projection(transform(messages))
        .writeStream.format(fmt)
        .queryName(name)
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def await_any(spark: SparkSession, timeout: int | None = None) -> bool | None:
    """Block until any query of the session ends."""
    return spark.streams.awaitAnyTermination(timeout)
