"""Uniqueness of a key in a table that batches are appended to.

Every batch leaves, for each date, a Bloom filter of its keys as rows: a key falls into one word of 64 bits and sets four of
them. A new row whose bits are not all set by earlier batches is new for certain. Only the others are compared with
stored rows, and only dates that hold such rows are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra import schemas
from telemetra.sinks.batches import Shape, Sink
from telemetra.sources.scans import materialise
from telemetra.tables import Table

FILTER = T.StructType([T.StructField("word", T.LongType()), T.StructField("bits", T.LongType()), *schemas.STORED_PARTITIONS.fields])
# Words of a date's filter: ten bits a key for some twenty-five million keys. More keys make more comparisons, no wrong result.
WORDS = 1 << 22
BITS_OF_KEY = 4
DATE, BATCH = schemas.STORED_PARTITIONS.names


@dataclass(frozen=True)
class Guard:
    """Keeps a key unique in a table of (event_date, batch_id); the key decides the date."""

    table: Table
    keys: tuple[str, ...] = ("sensor_id", "event_time")
    words: int = WORDS

    @property
    def filters(self) -> Table:
        return Table(f"{self.table.name}_keys", f"{self.table.path}_keys", FILTER, (DATE, BATCH))

    def _word(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.words))

    def _mask(self) -> Column:
        """The bits that a key sets in its word, each chosen by six bits of a second hash."""
        second, one, mask = F.xxhash64(F.lit("bits"), *self.keys), F.lit(1).cast("long"), F.lit(0).cast("long")
        for n in range(BITS_OF_KEY):
            place = F.shiftrightunsigned(second, 6 * n).bitwiseAND(F.lit(63).cast("long")).cast("int")
            mask = mask.bitwiseOR(F.call_function("shiftleft", one, place))
        return mask

    def marked(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({"_word": self._word(), "_mask": self._mask()})

    def known(self, spark: SparkSession, first: date, last: date, batch_id: int) -> DataFrame:
        """Words of some dates as all other batches have left them."""
        stored = self.filters.read_dates(spark, first, last).filter(F.col(BATCH) != batch_id)
        return stored.groupBy(F.col(DATE).alias("_date"), F.col("word").alias("_at")).agg(F.bit_or("bits").alias("_bits"))

    def clashes(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Keys of stored ``rows`` that other batches hold. Only dates with possible clashes are read."""
        spark = rows.sparkSession
        days = rows.agg(F.min(DATE).alias("first"), F.max(DATE).alias("last")).first()
        none = rows.select(*self.keys).limit(0)
        if days["first"] is None:
            return none
        marked = self.marked(rows)
        met = (F.col(DATE) == F.col("_date")) & (F.col("_word") == F.col("_at"))
        all_set = F.col("_bits").bitwiseAND(F.col("_mask")) == F.col("_mask")
        possible = marked.join(self.known(spark, days["first"], days["last"], batch_id), met & all_set, "left_semi").select(DATE, *self.keys)
        with materialise(possible, "possible-clashes") as staged:
            flagged = sorted(row[DATE] for row in staged.rows.select(DATE).distinct().collect())
            if not flagged:
                return none
            stored = self.table.read_days(spark, flagged).filter(F.col(BATCH) != batch_id)
            found = staged.rows.join(stored.select(*self.keys), list(self.keys), "left_semi").select(*self.keys)
            return materialise(found.distinct(), "clashes").until_exit()

    def sink(self, shape: Shape) -> Sink:
        """Write rows whose key is new: of several with one key in a batch that of the smallest row_id, and none that another batch holds.

        Rows without a time have no date to be looked up by, so all of them stay. A replayed batch replaces its rows and its
        filter. The filter is written first: should the rows then be lost, a later batch is compared in vain, but none gets past.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            added = {DATE: F.to_date("event_time"), BATCH: F.lit(batch_id).cast("bigint")}
            with materialise(shape(batch).withColumns(added), "unique-batch") as staged:
                rows, untimed = staged.rows.filter("event_time IS NOT NULL"), staged.rows.filter("event_time IS NULL")
                first = Window.partitionBy(*self.keys).orderBy("row_id")
                once = rows.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")
                fresh = once.join(self.clashes(rows, batch_id), list(self.keys), "left_anti")
                with materialise(fresh.select(*staged.rows.columns), "unique-fresh") as kept:
                    words = self.marked(kept.rows).groupBy(F.col("_word").alias("word"), DATE, BATCH).agg(F.bit_or("_mask").alias("bits"))
                    self.filters.replace_partitions(words)
                    self.table.replace_partitions(kept.rows.unionByName(untimed))

        return write

