"""Closed dates of a table in few large files, with the limits of each file.

The ETL writes a folder for each date and batch. ``compact`` packs the batches of dates that are over into files of an even
size, sorted by sensor and time, and notes the lowest and highest of both for every file. One new version of the compacted
table replaces all batches it holds; what it does not hold, late batches as well, is read from the batch folders beside it. A read
of one sensor and a short time opens only files whose limits meet it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.functions.times import Instant, instant
from telemetra.sources.scans import remove
from telemetra.versions import Version, VersionedTable, children, size_of

# Folder of the compacted rows below the table's; scans of the table skip names that begin with an underscore.
FOLDER = "_compacted"
FILE_BYTES, JOB_BYTES = 128 << 20, 64 << 30
DATE, BATCH = "event_date", "batch_id"
LIMITS = "folder string, file string, n_rows long, first_time timestamp, last_time timestamp, first_sensor string, last_sensor string, untimed long, unnamed long"


@dataclass(frozen=True)
class Wanted:
    """What a read is for: a sensor, a time from (included) and to (not included); None where anything will do."""

    sensor: str | None = None
    start: Instant | None = None
    end: Instant | None = None

    def of_rows(self) -> Column:
        """Whether a row is wanted."""
        condition = F.lit(True)
        if self.sensor is not None:
            condition &= F.col("sensor_id") == self.sensor
        if self.start is not None:
            condition &= F.col("event_time") >= instant(self.start)
        if self.end is not None:
            condition &= F.col("event_time") < instant(self.end)
        return condition

    def of_files(self) -> Column:
        """Whether a file's limits leave room for a wanted row."""
        condition = F.lit(True)
        if self.sensor is not None:
            condition &= (F.col("first_sensor") <= self.sensor) & (F.col("last_sensor") >= self.sensor)
        if self.start is not None:
            condition &= F.col("last_time") >= instant(self.start)
        if self.end is not None:
            condition &= F.col("first_time") < instant(self.end)
        return condition


def packed(sizes: dict[str, int], most: int) -> list[list[str]]:
    """Dates in jobs of at most so many bytes each, the largest first; one that is larger has a job of its own."""
    jobs: list[tuple[int, list[str]]] = []
    for day in sorted(sizes, key=lambda d: (-sizes[d], d)):
        for i, (filled, days) in enumerate(jobs):
            if filled + sizes[day] <= most:
                jobs[i] = (filled + sizes[day], [*days, day])
                break
        else:
            jobs.append((sizes[day], [day]))
    return [sorted(days) for _, days in jobs]


def _values(names: list[str], column: str) -> Iterator[str]:
    """Values of a partition column among folder names."""
    return (name.removeprefix(f"{column}=") for name in names if name.startswith(f"{column}="))


@dataclass(frozen=True)
class Compacted:
    """The compacted part of a table that is partitioned by date and batch."""

    path: str
    schema: T.StructType

    @property
    def table(self) -> VersionedTable:
        return VersionedTable(f"{self.path.rsplit('/', 1)[-1]}_compacted", f"{self.path}/{FOLDER}", self.schema, (DATE,))

    def batches(self, version: Version, day: str) -> set[str]:
        """Batches of a date that the compacted rows stand for."""
        return set(version.notes.get(day, {}).get("batches", ()))

    def open_folders(self, spark: SparkSession, version: Version, days: list[str]) -> dict[str, list[str]]:
        """Folders of batches that the compacted rows don't hold, by date."""
        found = {}
        for day in days:
            held, folder = self.batches(version, day), f"{self.path}/{DATE}={day}"
            names = list(_values(children(spark, folder), BATCH))
            found[day] = [f"{folder}/{BATCH}={name}" for name in names if name not in held]
        return {day: folders for day, folders in found.items() if folders}

    def days(self, spark: SparkSession) -> list[str]:
        """All dates with batch folders."""
        return list(_values(children(spark, self.path), DATE))

    def files(self, spark: SparkSession, version: Version, days: list[str], wanted: Wanted | None) -> list[str]:
        """What of the compacted rows is to be opened: the folders of dates or, for a narrow read, single files."""
        if wanted is None or not days:
            return self.table.paths(version, days)
        runs = sorted({version.notes[day]["limits"] for day in days})
        limits = spark.read.schema(LIMITS).parquet(*[f"{self.table.path}/limits/{run}" for run in runs])
        current = F.col("folder").isin([version.folders[day] for day in days])
        found = limits.filter(current & wanted.of_files()).select("folder", "file").collect()
        return [f"{self.table.path}/data/{row['folder']}/{row['file']}" for row in found]

    def read(self, spark: SparkSession, days: list[str] | None = None, wanted: Wanted | None = None, number: int | None = None) -> DataFrame:
        """Rows of some dates, all by default: compacted where they are, else batch by batch."""
        version = self.table.version(spark, number)
        if not version.number and days is None and wanted is None:
            return spark.read.schema(self.schema).parquet(self.path)
        closed = sorted(day for day in version.folders if days is None or day in days)
        folders = self.open_folders(spark, version, self.days(spark) if days is None else days)
        rows = spark.createDataFrame([], self.schema)
        open_ = [folder for each in folders.values() for folder in each]
        if open_:
            rows = spark.read.schema(self.schema).option("basePath", self.path).parquet(*open_)
        files = self.files(spark, version, closed, wanted)
        if files:
            compacted = spark.read.schema(self.schema).parquet(*files)
            rows = rows.unionByName(compacted) if open_ else compacted
        return rows if wanted is None else rows.filter(wanted.of_rows())


def limits_of(files: DataFrame) -> DataFrame:
    """Limits of each file of a scan; rows without a time or a sensor are counted, since limits pass them over."""
    folder = F.regexp_extract("_metadata.file_path", "([^/]+/[^/]+)/[^/]+$", 1).alias("folder")
    return files.groupBy(folder, F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("event_time").alias("first_time"),
        F.max("event_time").alias("last_time"),
        F.min("sensor_id").alias("first_sensor"),
        F.max("sensor_id").alias("last_sensor"),
        F.count_if(F.col("event_time").isNull()).alias("untimed"),
        F.count_if(F.col("sensor_id").isNull()).alias("unnamed"),
    )


def compact(spark: SparkSession, table: Any, before: date, file_bytes: int = FILE_BYTES, job_bytes: int = JOB_BYTES) -> list[str]:
    """Compact the dates before ``before`` that have batches outside the compacted rows; returns these dates.

    Rows stay the same; readers see a job's dates change at once. The merged batch folders stay for readers at work, until
    ``sweep``. Should another compaction of the same dates have been faster, this one's files are dropped.
    """
    compacted = Compacted(table.path, table.schema)
    store, done = compacted.table, []
    base = store.version(spark)
    days = [day for day in compacted.days(spark) if day < before.isoformat()]
    open_ = compacted.open_folders(spark, base, days)
    sizes = {day: sum(size_of(spark, folder) for folder in folders) + sum(size_of(spark, path) for path in store.paths(base, [day] if day in base.folders else [])) for day, folders in open_.items()}
    for job in packed(sizes, job_bytes):
        n_files = sum(-(-sizes[day] // file_bytes) or 1 for day in job)
        order = (DATE, "sensor_id", "event_time")

        def sorted_files(rows: DataFrame, n: int = n_files) -> DataFrame:
            # Ranges of (date, sensor, time) hold as many rows each, however rows are spread over dates and sensors.
            return rows.repartitionByRange(n, *order).sortWithinPartitions(*order)

        written = store.write_run(compacted.read(spark, job, number=base.number), sorted_files)
        run = next(iter(written.values())).split("/")[0] if written else None
        if run is None:
            continue
        files = spark.read.schema(compacted.schema).parquet(*[f"{store.path}/data/{folder}" for folder in written.values()])
        limits_of(files).coalesce(1).write.parquet(f"{store.path}/limits/{run}")
        held = {day: sorted(compacted.batches(base, day) | {folder.rsplit("=", 1)[1] for folder in open_[day]}) for day in job}
        notes = {day: {"batches": held[day], "limits": run} for day in written}
        if store.commit(spark, base, written, notes, strict=True) is None:
            remove(spark, f"{store.path}/data/{run}")
            remove(spark, f"{store.path}/limits/{run}")
            continue
        done += sorted(written)
    return sorted(done)


def sweep(spark: SparkSession, table: Any, keep: int = 1) -> list[str]:
    """Remove batch folders whose rows are compacted, and versions but the last ``keep``; returns the removed batch folders.

    Call it when readers that began before the compaction are done.
    """
    compacted = Compacted(table.path, table.schema)
    version = compacted.table.version(spark)
    gone = []
    for day in version.folders:
        held = compacted.batches(version, day)
        for batch in _values(children(spark, f"{table.path}/{DATE}={day}"), BATCH):
            if batch in held:
                gone.append(f"{DATE}={day}/{BATCH}={batch}")
                remove(spark, f"{table.path}/{gone[-1]}")
    compacted.table.vacuum(spark, keep)
    needed = {note["limits"] for number in compacted.table.versions(spark) for note in compacted.table.version(spark, number).notes.values()}
    for run in children(spark, f"{compacted.table.path}/limits"):
        if run not in needed:
            remove(spark, f"{compacted.table.path}/limits/{run}")
    return gone
