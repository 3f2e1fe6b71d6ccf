"""A shelf of fitted MLlib pipelines: kept with version, inputs and metrics, and applied to batches and streams later."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from telemetra.sources.scans import remove
from telemetra.versions import children, read_text, write_once

VERSION_DIGITS = 9
ENTRY = "kind string, version int, created_at string, folder string, inputs array<string>, n_rows long, metrics map<string,double>"


class UnknownPipeline(KeyError):
    """The shelf holds no such pipeline."""


@dataclass(frozen=True)
class Learned:
    """A fitted pipeline, what it reads, how many rows it was fitted on, and how well it did."""

    kind: str
    model: PipelineModel
    inputs: tuple[str, ...]
    n_rows: int
    metrics: dict[str, float]


@dataclass(frozen=True)
class Shelf:
    """Pipelines below one folder. A version is there as a whole or not at all, and is never changed."""

    path: str

    def _entry(self, kind: str, version: int) -> str:
        return f"{self.path}/{kind}/{version:0{VERSION_DIGITS}}.json"

    def versions(self, spark: SparkSession, kind: str) -> list[int]:
        return [int(name[:VERSION_DIGITS]) for name in children(spark, f"{self.path}/{kind}") if name.endswith(".json")]

    def save(self, spark: SparkSession, learned: Learned, created_at: str) -> int:
        """Keep a pipeline as the next version of its kind; two jobs that save at a time get different ones."""
        folder = f"pipelines/{learned.kind}-{uuid.uuid4().hex}"
        try:
            learned.model.write().save(f"{self.path}/{folder}")
        except Exception:
            remove(spark, f"{self.path}/{folder}")
            raise
        while True:
            version = max(self.versions(spark, learned.kind), default=0) + 1
            entry = {
                "kind": learned.kind, "version": version, "created_at": created_at, "folder": folder,
                "inputs": list(learned.inputs), "n_rows": learned.n_rows, "metrics": learned.metrics,
            }
            if write_once(spark, self._entry(learned.kind, version), json.dumps(entry)):
                return version

    def entry(self, spark: SparkSession, kind: str, version: int | None = None) -> dict:
        """What is known of a version, the latest by default."""
        known = self.versions(spark, kind)
        if not known or version is not None and version not in known:
            raise UnknownPipeline(f"no {kind!r} of version {version or 'any'}")
        return json.loads(read_text(spark, self._entry(kind, version or known[-1])))

    def load(self, spark: SparkSession, kind: str, version: int | None = None) -> Learned:
        entry = self.entry(spark, kind, version)
        model = PipelineModel.load(f"{self.path}/{entry['folder']}")
        return Learned(kind, model, tuple(entry["inputs"]), entry["n_rows"], entry["metrics"])

    def entries(self, spark: SparkSession) -> DataFrame:
        """A row for each version of every kind."""
        kinds = [name for name in children(spark, self.path) if name != "pipelines"]
        if not kinds:
            return spark.createDataFrame([], ENTRY)
        return spark.read.schema(ENTRY).json([f"{self.path}/{kind}" for kind in kinds])
