"""URL rules by a sort-merge range join.

A host's labels in reverse order make a key in which a host and all its subdomains form one interval, so a rule is an
interval of keys, and rules nest. Rules and pages are dealt out by ranges of keys and sorted; one sweep over a
range keeps the active rules, each inside the one below it, on a stack. A rule goes to every range that its
interval meets, which are its own and those that lie inside it.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Ranges for each shuffle partition, and rows looked at to choose the limits of each range.
RANGES, SAMPLES = 4, 8
# Above every character of a key.
AFTER = "\U0010ffff"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a url; both empty if it is null or has no ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, parts, i), F.lit("")) for i in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def host_key(host: Column) -> Column:
    """Labels in reverse order, each with a dot behind it: keys of subdomains begin with the host's."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _limits(rows: DataFrame, n_ranges: int) -> list[tuple[str, str, int]]:
    """Lower limits of all ranges but the first, from a sample of fixed size."""
    sample = rows.orderBy("mixed", "key", "path").limit(n_ranges * SAMPLES).select("key", "path", "mixed").collect()
    # Rows are chosen by a hash and placed by another one, so that a range of equal urls is cut evenly.
    places = sorted((r["key"], r["path"], hash_of(r["mixed"])) for r in sample)
    return [places[len(places) * i // n_ranges] for i in range(1, n_ranges)] if places else []


def hash_of(number: int) -> int:
    """Another order of hashes."""
    return number * 0x9E3779B97F4A7C15 % 2**64


class Sweep:
    """Active rules, innermost last: (key, paths by length), where paths give (rule, verdict)."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, dict[int, dict[str, tuple[str, str]]]]] = []

    def move(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def add(self, key: str, path: str, rule: str, verdict: str) -> None:
        self.move(key)
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, {}))
        paths = self.stack[-1][1].setdefault(len(path), {})
        if paths.get(path, ("", ALLOW))[1] == ALLOW:
            paths[path] = (rule, verdict)

    def judge(self, key: str, path: str) -> tuple[str | None, str | None]:
        """The longest rule that fits; of equally long ones that of the longer host."""
        self.move(key)
        best, found = -1, (None, None)
        for host, lengths in reversed(self.stack):
            for length, paths in lengths.items():
                if len(host) + length > best and length <= len(path) and (fits := paths.get(path[:length])):
                    best, found = len(host) + length, fits
        return found


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """Rows (id, host, path, rule, verdict), one for every row of ``pages``.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all subdomains if the url's path
    begins with the rule's; the longest decides, and of rules with the same host and path one that blocks. Rules with a
    null are left out. A url that no rule fits, as a null one, has a null rule and the ``default``.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_column))
    rows = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path")).withColumn("key", host_key(F.col("host")))
    rows = rows.withColumn("mixed", F.xxhash64("id", "key", "path"))
    n_ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    limits = _limits(rows, n_ranges)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series, paths: pd.Series, mixed: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(limits, (key, path, hash_of(m))) for key, path, m in zip(keys, paths, mixed)], dtype="int32")

    @F.pandas_udf("array<int>")
    def ranges_of(keys: pd.Series) -> pd.Series:
        spans = [(bisect_right(limits, (key, "", -1)), bisect_right(limits, (key + AFTER, "", -1))) for key in keys]
        return pd.Series([list(range(low, high + 1)) for low, high in spans], dtype=object)

    known = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").dropna().distinct()
    known = known.withColumn("key", host_key(F.col("host"))).withColumn("range", F.explode(ranges_of("key")))
    kind = rows.schema["id"].dataType
    known = known.select("range", "key", F.lit(0).alias("is_page"), "path", F.lit(None).cast(kind).alias("id"), "host", "verdict")
    asked = rows.select(range_of("key", "path", "mixed").alias("range"), "key", F.lit(1).alias("is_page"), "path", "id", "host", F.lit(None).cast("string").alias("verdict"))
    order = ("range", "key", "is_page")

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, active = None, Sweep()
        for batch in batches:
            found = []
            for number, key, is_page, path, host, verdict in zip(*(batch[c] for c in ("range", "key", "is_page", "path", "host", "verdict"))):
                if number != now:
                    now, active = number, Sweep()
                if is_page:
                    found.append(active.judge(key, path))
                else:
                    active.add(key, path, host + path, verdict)
            if not found:
                continue
            result = batch.loc[batch["is_page"] == 1, ["id", "host", "path"]].copy()
            result["rule"] = [rule for rule, _ in found]
            result["verdict"] = [verdict or default for _, verdict in found]
            yield result

    dealt = known.unionByName(asked).repartition(n_ranges // RANGES, "range").sortWithinPartitions(*order)
    judged = dealt.mapInPandas(sweep, f"id {kind.simpleString()}, host string, path string, rule string, verdict string")
    return judged.withColumnRenamed("id", id_column)
