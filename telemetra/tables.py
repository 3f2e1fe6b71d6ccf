"""The stored tables: parquet folders with a declared schema, written partition by partition."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra import schemas
from telemetra.compaction import Compacted, Wanted
from telemetra.functions.times import Instant, instant
from telemetra.operators.learned import Shelf
from telemetra.versions import VersionedTable

# Dates beyond this, and the folder of rows without a date, are none.
MAX_DAY = "9999-12-31"


@dataclass(frozen=True)
class Table:
    name: str
    path: str
    schema: T.StructType
    partitions: tuple[str, ...]

    def create(self, spark: SparkSession) -> None:
        """Create the empty table; an existing one is left as it is."""
        empty = spark.createDataFrame([], self.schema)
        empty.write.mode("ignore").partitionBy(*self.partitions).parquet(self.path)

    @property
    def by_batch(self) -> bool:
        """Whether the streaming ETL writes this table, so that its closed dates can be compacted."""
        return self.partitions == tuple(schemas.STORED_PARTITIONS.names)

    def read(self, spark: SparkSession) -> DataFrame:
        if self.by_batch:
            return Compacted(self.path, self.schema).read(spark)
        return spark.read.schema(self.schema).parquet(self.path)

    def read_dates(self, spark: SparkSession, first: date, last: date | None = None) -> DataFrame:
        """The rows of some dates, to the latest one if ``last`` is None, without listing the folders of any other.

        For tables partitioned by date first.
        """
        compacted = Compacted(self.path, self.schema)
        if last is None:
            closed = set(compacted.table.version(spark).folders)
            days = sorted(day for day in closed | set(compacted.days(spark)) if first.isoformat() <= day <= MAX_DAY)
        else:
            days = [(first + timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]
        return compacted.read(spark, days)

    def read_days(self, spark: SparkSession, days: list[date]) -> DataFrame:
        """The rows of single dates."""
        return Compacted(self.path, self.schema).read(spark, [day.isoformat() for day in days])

    def read_window(self, spark: SparkSession, start: Instant, end: Instant, sensor: str | None = None) -> DataFrame:
        """Rows from ``start`` to before ``end``, of one sensor or all. Of compacted dates only files with such rows are opened."""
        at = spark.range(1).select(F.to_date(instant(start)).alias("first"), F.to_date(instant(end)).alias("last")).first()
        days = [(at["first"] + timedelta(days=n)).isoformat() for n in range((at["last"] - at["first"]).days + 1)]
        return Compacted(self.path, self.schema).read(spark, days, Wanted(sensor, start, end))

    def replace_partitions(self, df: DataFrame) -> None:
        """Write rows, replacing exactly the partitions they belong to."""
        (
            df.select(*self.schema.names)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partitions)
            .parquet(self.path)
        )

    def register(self, spark: SparkSession) -> None:
        """Make the table known to SQL under its name; once it has compacted dates, as a view for reading."""
        if self.by_batch and Compacted(self.path, self.schema).table.versions(spark):
            self.read(spark).createOrReplaceTempView(self.name)
            return
        columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in self.schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({columns}) USING parquet "
            f"PARTITIONED BY ({', '.join(self.partitions)}) LOCATION '{self.path}'"
        )
        spark.catalog.recoverPartitions(self.name)


class Store:
    """All tables of one installation, below one root folder."""

    def __init__(self, root: str):
        def table(name: str, schema: T.StructType, *partitions: str) -> Table:
            return Table(name, f"{root.rstrip('/')}/{name}", schema, partitions)

        by_batch = schemas.STORED_PARTITIONS.names
        self.readings = table("sensor_readings", schemas.stored(schemas.READINGS), *by_batch)
        self.anomalies = table("sensor_anomalies", schemas.stored(schemas.ANOMALIES), *by_batch)
        self.hourly = table("sensor_hourly", T.StructType([*schemas.HOURLY.fields, *schemas.STORED_PARTITIONS.fields]), *by_batch)
        self.summary = VersionedTable("sensor_daily_summary", f"{root.rstrip('/')}/sensor_daily_summary", schemas.SUMMARY, ("summary_date",))
        self.scores = table("sensor_scores", schemas.stored(schemas.SCORES), *by_batch)
        self.nodes = table("forest_nodes", schemas.FOREST_NODES, "model_id")
        self.models = table("models", schemas.MODELS, "model_id")
        self.learned = Shelf(f"{root.rstrip('/')}/learned")
        self.promotions = table("promotions", schemas.PROMOTIONS, "model_id")

    def tables(self) -> tuple[Table | VersionedTable, ...]:
        return (self.readings, self.anomalies, self.hourly, self.scores, self.summary, self.nodes, self.models, self.promotions)

    def create(self, spark: SparkSession) -> None:
        for table in self.tables():
            table.create(spark)

    def upsert_summary(self, new: DataFrame, summary_date: Column) -> None:
        self.summary.upsert(new, schemas.SUMMARY_KEYS, F.col("summary_date") == summary_date)
