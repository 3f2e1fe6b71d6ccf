"""Event times and the three kinds of time window."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.rules import SUMMARY_HOURS

Instant = str | datetime


def instant(at: Instant) -> Column:
    """Timestamp literal. It goes through text, because a datetime would take the driver's zone."""
    text = at.isoformat(sep=" ") if isinstance(at, datetime) else at
    return F.lit(text).cast("timestamp")


def event_time(text: Column) -> Column:
    """ISO text to timestamp; unreadable text gives NULL and must not stop a stream."""
    return F.try_to_timestamp(text)


def hours_before(at: Instant, hours: int) -> Column:
    return instant(at) - F.make_dt_interval(hours=F.lit(hours))


def between_dates(df: DataFrame, predicate: Column, first: Column | None, last: Column | None) -> DataFrame:
    """Add date bounds where the table is partitioned by event_date, so that partitions are pruned."""
    if "event_date" in df.columns:
        if first is not None:
            predicate = predicate & (F.col("event_date") >= F.to_date(first))
        if last is not None:
            predicate = predicate & (F.col("event_date") <= F.to_date(last))
    return df.filter(predicate)


def rolling_window(df: DataFrame, as_of: Instant, hours: int = SUMMARY_HOURS) -> DataFrame:
    """Rows of the half-open window [as_of - hours, as_of)."""
    start, end, when = hours_before(as_of, hours), instant(as_of), F.col("event_time")
    return between_dates(df, (when >= start) & (when < end), start, end)


def recent_window(df: DataFrame, as_of: Instant, hours: int = SUMMARY_HOURS) -> DataFrame:
    """Rows from as_of - hours on, with no upper end."""
    start = hours_before(as_of, hours)
    return between_dates(df, F.col("event_time") >= start, start, None)


def closed_window(df: DataFrame, start: Instant, end: Instant) -> DataFrame:
    """Rows of the closed range [start, end]."""
    first, last = instant(start), instant(end)
    return between_dates(df, F.col("event_time").between(first, last), first, last)
