"""Tables whose state is named by a small file, so that a write becomes visible all at once or not at all.

Rows of a write go into a folder of their own. The manifest of a version names the folder of every partition; putting the next
manifest in place is the only step that readers notice, and it fails if another writer has done so first. A reader keeps to the
version it began with, since no file of it is touched until ``vacuum`` removes old versions.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra.operators.upsert import upsert
from telemetra.sources.scans import materialise, remove

# Column by which a write is split into the folders of its partitions; rows keep their own column.
PART = "part"
MANIFEST_DIGITS = 12


class ConcurrentWrite(RuntimeError):
    """Another writer changed the same partitions meanwhile, again and again."""


class UnknownVersion(KeyError):
    """The table has no such version, or no longer."""


def _path(spark: SparkSession, folder: str) -> tuple[Any, Any]:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    files, path = _path(spark, folder)
    return sorted(status.getPath().getName() for status in files.listStatus(path)) if files.exists(path) else []


def size_of(spark: SparkSession, folder: str) -> int:
    """Bytes of all files in a folder."""
    files, path = _path(spark, folder)
    return files.getContentSummary(path).getLength()


def read_text(spark: SparkSession, name: str) -> str:
    files, path = _path(spark, name)
    stream = files.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, name: str, text: str) -> bool:
    """Put a file in place, whole; false if there is one of that name already.

    The file is written under another name and renamed, which stores with an atomic rename (HDFS, local) do for one of several
    writers only. An object store needs a committer or connector that gives the same.
    """
    draft = f"{name}.{uuid.uuid4().hex}.draft"
    files, path = _path(spark, draft)
    stream = files.create(path, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    no_options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(path, jvm.org.apache.hadoop.fs.Path(name), no_options)
    except Py4JJavaError as error:
        files.delete(path, False)
        if error.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
            return False
        raise
    return True


@dataclass(frozen=True)
class Version:
    """Folder of every partition, and what writers noted about it."""

    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    notes: dict[str, dict] = field(default_factory=dict)


@dataclass(frozen=True)
class VersionedTable:
    """A table of one partition column, with versions."""

    name: str
    path: str
    schema: T.StructType
    partitions: tuple[str, ...]
    attempts: int = 5

    # --- versions

    def _manifest(self, number: int) -> str:
        return f"{self.path}/versions/{number:0{MANIFEST_DIGITS}}.json"

    def versions(self, spark: SparkSession) -> list[int]:
        """Numbers of the versions that can be read, oldest first."""
        names = children(spark, f"{self.path}/versions")
        return [int(name[:MANIFEST_DIGITS]) for name in names if name.endswith(".json")]

    def version(self, spark: SparkSession, number: int | None = None) -> Version:
        """A version, the latest by default; before the first write an empty one."""
        known = self.versions(spark)
        if number is None:
            number = known[-1] if known else 0
        if number == 0:
            return Version()
        if number not in known:
            raise UnknownVersion(f"{self.name} has no version {number}")
        content = json.loads(read_text(spark, self._manifest(number)))
        return Version(number, content["folders"], content["notes"])

    def commit(self, spark: SparkSession, base: Version, folders: dict[str, str], notes: dict[str, dict] | None = None, strict: bool = False) -> Version | None:
        """Make written folders the table's next version; what other writers have changed meanwhile stays.

        ``strict`` gives None instead if one of these partitions is not what it was in ``base``.
        """
        for _ in range(100):
            latest = self.version(spark)
            if strict and any(latest.folders.get(part) != base.folders.get(part) for part in folders):
                return None
            new = Version(latest.number + 1, {**latest.folders, **folders}, {**latest.notes, **(notes or {})})
            if write_once(spark, self._manifest(new.number), json.dumps({"folders": new.folders, "notes": new.notes})):
                return new
        raise ConcurrentWrite(f"{self.name}: other writers were faster a hundred times")

    # --- rows

    def create(self, spark: SparkSession) -> None:
        """Nothing to do: a table without a version is empty."""

    def paths(self, version: Version, parts: list[str]) -> list[str]:
        return [f"{self.path}/data/{version.folders[part]}" for part in parts]

    def _rows(self, spark: SparkSession, version: Version, parts: list[str]) -> DataFrame:
        if not parts:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*self.paths(version, parts))

    def read(self, spark: SparkSession, number: int | None = None) -> DataFrame:
        """All rows of a version, the latest by default. Later writes don't change what is read."""
        version = self.version(spark, number)
        return self._rows(spark, version, sorted(version.folders))

    def read_dates(self, spark: SparkSession, first: date, last: date, number: int | None = None) -> DataFrame:
        """The rows of some dates; no folder of any other is looked at."""
        version = self.version(spark, number)
        return self._rows(spark, version, sorted(part for part in version.folders if first.isoformat() <= part <= last.isoformat()))

    def write_run(self, df: DataFrame, shape: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> dict[str, str]:
        """Write rows into a folder of their own; the folder of each partition, which no reader sees yet."""
        run = uuid.uuid4().hex
        rows = shape(df.select(*self.schema.names).withColumn(PART, F.col(self.partitions[0]).cast("string")))
        folder = f"{self.path}/data/{run}"
        try:
            rows.write.partitionBy(PART).parquet(folder)
        except Exception:
            remove(df.sparkSession, folder)
            raise
        prefix = f"{PART}="
        return {name.removeprefix(prefix): f"{run}/{name}" for name in children(df.sparkSession, folder) if name.startswith(prefix)}

    def replace_partitions(self, df: DataFrame) -> None:
        """Write rows, replacing exactly the partitions they belong to; of two writers of one partition the last one stays."""
        spark = df.sparkSession
        self.commit(spark, Version(), self.write_run(df))

    def upsert(self, new: DataFrame, keys: tuple[str, ...], touched: Column) -> None:
        """Insert new rows and overwrite those of the same key, all or nothing.

        ``touched`` selects the partitions that ``new`` falls into; only these are read and rewritten. Should another writer
        change one of them meanwhile, the new rows are merged with what that one has written.
        """
        spark = new.sparkSession
        with materialise(new.select(*self.schema.names), f"upsert-{self.name}") as staged:
            for _ in range(self.attempts):
                base = self.version(spark)
                old = self._rows(spark, base, sorted(base.folders)).filter(touched)
                written = self.write_run(upsert(old, staged.rows, keys))
                if not written or self.commit(spark, base, written, strict=True) is not None:
                    return
                self._discard(spark, written)
        raise ConcurrentWrite(f"{self.name}: partitions {sorted(written)} changed at every attempt")

    def _discard(self, spark: SparkSession, written: dict[str, str]) -> None:
        for run in {folder.split("/")[0] for folder in written.values()}:
            remove(spark, f"{self.path}/data/{run}")

    def register(self, spark: SparkSession) -> None:
        """Make the latest version known to SQL under its name, as a view for reading."""
        self.read(spark).createOrReplaceTempView(self.name)

    def vacuum(self, spark: SparkSession, keep: int = 2, abandoned_hours: float = 24.0) -> list[str]:
        """Remove all versions but the last ``keep``, and folders that none of these names; returns the removed folders.

        A folder that no version ever named may belong to a writer at work, so it goes only when it is so many hours old.
        """
        if keep < 1:
            raise ValueError("the latest version must stay")
        known = self.versions(spark)
        old, kept = known[:-keep], known[-keep:]
        named_before = {folder for number in old for folder in self.version(spark, number).folders.values()}
        needed = {folder for number in kept for folder in self.version(spark, number).folders.values()}
        for number in old:
            remove(spark, self._manifest(number))
        gone = []
        files, _ = _path(spark, self.path)
        for run in children(spark, f"{self.path}/data"):
            for name in children(spark, f"{self.path}/data/{run}"):
                folder = f"{run}/{name}"
                if not name.startswith(f"{PART}=") or folder in needed:
                    continue
                path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data/{folder}")
                age = time.time() - files.getFileStatus(path).getModificationTime() / 1000
                if folder in named_before or age >= abandoned_hours * 3600:
                    files.delete(path, True)
                    gone.append(folder)
            if not any(name.startswith(f"{PART}=") for name in children(spark, f"{self.path}/data/{run}")) and gone and gone[-1].startswith(run):
                remove(spark, f"{self.path}/data/{run}")
        return gone
