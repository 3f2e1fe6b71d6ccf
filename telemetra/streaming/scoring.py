"""Scoring readings as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetra.operators.clean import clean
from telemetra.operators.enrich import enrich, flatten_readings
from telemetra.operators.forest import Forest, predict
from telemetra.operators.registry import current_model, load_forest
from telemetra.sinks.batches import Sink, table_sink
from telemetra.sources.messages import parse
from telemetra.sources.scans import remove
from telemetra.tables import Store, Table
from telemetra.versions import children, read_text, write_once

# Batches whose model stays on record; only the last one can be replayed.
RECORDED_BATCHES = 100


class NoModel(LookupError):
    """No model has been promoted yet."""


def arriving_readings(messages: DataFrame) -> DataFrame:
    """Messages, batch or stream, to readings with their keys."""
    return flatten_readings(enrich(clean(parse(messages))), carry=("row_id",))


def score_messages(messages: DataFrame, forest: Forest) -> DataFrame:
    """Messages, batch or stream, to readings with score and prediction of one model, fixed for the life of a stream."""
    return predict(arriving_readings(messages), forest).withColumn("model_id", F.lit(forest.model_id))


class Serving:
    """The model of each micro-batch: the one in production when the batch is first tried, and the same in every replay.

    The choice is put on record, once, before anything is written, in a folder beside the checkpoint. A forest is loaded when
    a batch first needs it and kept until another model takes over.
    """

    def __init__(self, store: Store, records: str):
        self.store, self.records = store, records.rstrip("/")
        self.loaded: Forest | None = None

    def _record(self, batch_id: int) -> str:
        return f"{self.records}/{batch_id:019}"

    def model_of(self, spark: SparkSession, batch_id: int) -> str:
        if f"{batch_id:019}" not in children(spark, self.records):
            current = current_model(self.store.models.read(spark), self.store.promotions.read(spark)).first()
            if current is None:
                raise NoModel("no model has been promoted yet")
            # Should another try of this batch have been faster, its choice holds.
            write_once(spark, self._record(batch_id), current["model_id"])
            for name in children(spark, self.records)[:-RECORDED_BATCHES]:
                remove(spark, f"{self.records}/{name}")
        return read_text(spark, self._record(batch_id))

    def forest_of(self, spark: SparkSession, batch_id: int) -> Forest:
        model_id = self.model_of(spark, batch_id)
        if self.loaded is None or self.loaded.model_id != model_id:
            self.loaded = load_forest(self.store, spark, model_id)
        return self.loaded

    def sink(self, table: Table) -> Sink:
        """Score a batch of readings into a table by (event_date, batch_id); a replay replaces itself."""

        def write(batch: DataFrame, batch_id: int) -> None:
            forest = self.forest_of(batch.sparkSession, batch_id)
            table_sink(table, lambda rows: predict(rows, forest).withColumn("model_id", F.lit(forest.model_id)))(batch, batch_id)

        return write


def run_scoring(messages: DataFrame, store: Store, checkpoint: str, trigger: dict | None = None, table: Table | None = None) -> StreamingQuery:
    """Score messages into ``store.scores`` or another table. A promotion counts from the next micro-batch on, without a restart."""
    serving = Serving(store, f"{checkpoint.rstrip('/')}-models")
    return (
        arriving_readings(messages)
        .writeStream.foreachBatch(serving.sink(table or store.scores))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
