"""Table scans: parquet, JDBC, and files handed from one job to the next."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from telemetra.session import workspace


def jdbc_scan_options(
    url: str, table: str, partition_column: str, lower: str, upper: str, num_partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """Options of a JDBC scan that is split over executors.

    The bounds only choose the split points: rows outside them are still read. Without them the
    whole table would come through one task.
    """
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(num_partitions),
        "fetchsize": str(fetch_size),
    }


def read_jdbc(spark: SparkSession, options: dict[str, str], **credentials: str) -> DataFrame:
    """Scan over JDBC; user, password and driver class are given by the caller."""
    return spark.read.format("jdbc").options(**options, **credentials).load()


def stage_file(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a dataset for a later job."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
    return path


def load_staged(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """Read a staged dataset with its declared schema."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


@dataclass(frozen=True)
class Staged:
    """A table in the shared folder that holds an intermediate result."""

    rows: DataFrame
    path: str

    def discard(self) -> None:
        """Remove the table, once nothing reads it any more."""
        remove(self.rows.sparkSession, self.path)

    def __enter__(self) -> Staged:
        return self

    def __exit__(self, *_: object) -> None:
        self.discard()

    def until_exit(self) -> DataFrame:
        """The rows, for a result that is read later; the table goes when the session's process ends."""
        remove_at_exit(self.rows.sparkSession, self.path)
        return self.rows


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder in any store that Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Delete a folder when the session's process ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def materialise(df: DataFrame, name: str) -> Staged:
    """Compute a DataFrame once, as a table in the shared folder, and continue from that table.

    The table outlives the executors that wrote it, and later steps read only the columns they use.
    """
    path = workspace(df.sparkSession, name)
    try:
        stage_file(df, path)
    except Exception:
        remove(df.sparkSession, path)
        raise
    return Staged(load_staged(df.sparkSession, path, df.schema), path)
