"""Exact quantile of a column that no single task could hold."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Up to this many values per group the built-in exact percentile is used: its buffer fits one task.
BUILTIN_ROWS = 200_000
BUCKETS = 16_384
# A bucket of at most this many values is fetched and sorted.
FETCH_ROWS = 10_000


@dataclass
class _Search:
    """The range that still holds the wanted value, and the number of values below it."""

    low: float
    high: float
    rank: int
    has_more: bool
    below: int = 0
    following: float | None = None
    whole: bool = True


def exact_quantile(
    df: DataFrame,
    value: str,
    q: float,
    by: str,
    counts: dict[str, int],
    bounds: tuple[float, float] = (0.0, 1.0),
    builtin_rows: int = BUILTIN_ROWS,
    fetch_rows: int = FETCH_ROWS,
) -> dict[str, float]:
    """Quantile ``q`` of ``value`` for each group in ``counts``, with linear interpolation.

    Large groups are narrowed down: one aggregation counts the values in equal buckets between the
    bounds, the bucket with the wanted rank gives the next bounds. Each pass reads ``df`` and brings
    back at most one row per bucket, so ``df`` should be a stored table. Equal values end the search
    however many there are. Wrong bounds only cost a further pass.
    """
    small = {group: n for group, n in counts.items() if 0 < n <= builtin_rows}
    found = _builtin(df, value, q, by, list(small)) if small else {}
    searches = {}
    for group, n in counts.items():
        if n > builtin_rows:
            position = (n - 1) * q
            searches[group] = _Search(*bounds, rank=floor(position), has_more=ceil(position) > floor(position))
    pairs = _narrow(df, value, by, searches, fetch_rows) if searches else {}
    for group, (lower, upper) in pairs.items():
        position = (counts[group] - 1) * q
        share = position - floor(position)
        found[group] = lower if lower == upper else (1 - share) * lower + share * upper
    return found


def _builtin(df: DataFrame, value: str, q: float, by: str, groups: list[str]) -> dict[str, float]:
    rows = df.filter(F.col(by).isin(groups)).groupBy(by).agg(F.percentile(value, q).alias("quantile")).collect()
    return {row[by]: row["quantile"] for row in rows}


def _in_range(value: str, by: str, searches: dict[str, _Search]) -> Column:
    condition = F.lit(False)
    for group, search in searches.items():
        inside = F.lit(True) if search.whole else F.col(value).between(search.low, search.high)
        condition = condition | ((F.col(by) == group) & inside)
    return condition


def _bucket(value: str, by: str, searches: dict[str, _Search]) -> Column:
    bucket = F.lit(None).cast("int")
    for group, search in searches.items():
        place = F.floor((F.col(value) - search.low) / (search.high - search.low) * BUCKETS)
        clamped = F.least(F.greatest(place, F.lit(0)), F.lit(BUCKETS - 1)).cast("int")
        bucket = F.when(F.col(by) == group, clamped).otherwise(bucket)
    return bucket


def _narrow(
    df: DataFrame, value: str, by: str, searches: dict[str, _Search], fetch_rows: int
) -> dict[str, tuple[float, float]]:
    """The values at the wanted rank and at the next one."""
    found: dict[str, tuple[float, float]] = {}
    fetch: dict[str, _Search] = {}
    open_searches = dict(searches)
    while open_searches:
        histogram = (
            df.filter(_in_range(value, by, open_searches))
            .groupBy(by, _bucket(value, by, open_searches).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
            .collect()
        )
        for group, search in list(open_searches.items()):
            buckets = sorted((row for row in histogram if row[by] == group), key=lambda row: row["bucket"])
            for place, row in enumerate(buckets):
                if search.below + row["n"] > search.rank:
                    break
                search.below += row["n"]
            if place + 1 < len(buckets):
                search.following = buckets[place + 1]["low"]
            search.low, search.high, search.whole = row["low"], row["high"], False
            if row["low"] == row["high"]:
                last = search.below + row["n"] - 1 == search.rank
                upper = search.following if last and search.has_more else row["low"]
                found[group] = (row["low"], upper)
            elif row["n"] <= fetch_rows:
                fetch[group] = search
            else:
                continue
            del open_searches[group]
    if fetch:
        rows = df.filter(_in_range(value, by, fetch)).select(by, value).collect()
        for group, search in fetch.items():
            values = sorted(row[value] for row in rows if row[by] == group)
            place = search.rank - search.below
            if not search.has_more:
                upper = values[place]
            else:
                upper = values[place + 1] if place + 1 < len(values) else search.following
            found[group] = (values[place], upper)
    return found
