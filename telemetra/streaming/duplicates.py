"""Messages that arrive more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetra.functions.times import event_time

# What makes two messages the same, whatever key or offset they came with.
SAME_MESSAGE = ("sensor_id", "timestamp")
_OWN = "_own_key"


def drop_repeats(parsed: DataFrame, delay: str, keys: tuple[str, ...] = SAME_MESSAGE) -> DataFrame:
    """Keep one message for each key among those whose event times lie within ``delay`` of the watermark.

    The watermark follows the latest event time by ``delay``. A key is remembered until the watermark passes its event time by
    ``delay``, so state is bounded by the messages of about twice that span, however long the stream runs; a message that
    is itself later than the watermark is dropped. Messages whose time cannot be read have no place in the watermark: all
    of them stay, and none is remembered for long. In a batch there is no watermark, and one message for each key stays.
    """
    timed = parsed.withColumns(
        {"event_time": event_time(F.col("timestamp")), _OWN: F.when(event_time(F.col("timestamp")).isNull(), F.col("row_id"))}
    )
    columns = [*keys, _OWN]
    if not parsed.isStreaming:
        return timed.dropDuplicates(columns).drop(_OWN)
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(columns).drop(_OWN)
