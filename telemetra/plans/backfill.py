"""Training on past ranges, several at a time."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra import rules
from telemetra.functions.keys import model_key
from telemetra.functions.times import Instant, instant
from telemetra.operators.evaluate import assert_healthy, health_score, with_pathology
from telemetra.operators.forest import Fitted, ForestSpec, Survey, fit_tagged, survey_tagged, with_prediction
from telemetra.operators.registry import save_model
from telemetra.operators.training import NotEnoughRows, assert_enough, extract_ranges
from telemetra.tables import Store

# Ranges fitted in the same jobs. It bounds the node rows on the driver and the width of the plan.
RANGES_PER_JOB = 16

METRICS = T.StructType(
    [
        T.StructField("model_id", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n_anomalies", T.LongType()),
        T.StructField("anomaly_rate", T.DoubleType()),
        T.StructField("health_score", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Backfill:
    fitted: dict[str, Fitted]
    metrics: DataFrame

    def discard(self) -> None:
        """Remove the stored training scores; models and metrics stay usable."""
        for fitted in self.fitted.values():
            fitted.stage.discard()


def model_keys(spark: SparkSession, ranges: list[tuple[str, str]]) -> list[str]:
    """Model key of every range, in the given order."""
    indexed = [(place, *bounds) for place, bounds in enumerate(ranges)]
    keys = spark.createDataFrame(indexed, "place INT, start STRING, end STRING").select(
        "place", model_key(F.col("start"), F.col("end")).alias("model_id")
    )
    return [row["model_id"] for row in keys.orderBy("place").collect()]


def backfill(
    readings: DataFrame,
    ranges: list[tuple[str, str]],
    min_rows: int = rules.MIN_TRAINING_ROWS,
    spec: ForestSpec = ForestSpec(),
    row_id: str = "row_id",
) -> Backfill:
    """Fit and evaluate one model per closed range (start, end); nothing is promoted.

    A range without rows, with too few valid rows, or with a pathological model is an error.
    """
    if not 0.01 <= spec.contamination <= 0.5:
        raise ValueError("contamination must lie between 0.01 and 0.5")
    spark = readings.sparkSession
    keys = model_keys(spark, ranges)
    parts = [
        _fit_ranges(readings, dict(list(zip(keys, ranges))[start : start + RANGES_PER_JOB]), min_rows, spec, row_id)
        for start in range(0, len(ranges), RANGES_PER_JOB)
    ]
    for part in parts:
        assert_healthy(part.metrics)
    return Backfill(
        {key: fitted for part in parts for key, fitted in part.fitted.items()},
        reduce(DataFrame.unionByName, [part.metrics for part in parts]),
    )


class BackfillFailed(RuntimeError):
    """Some ranges have no model; those of the others are stored."""

    def __init__(self, errors: dict[str, str]):
        super().__init__("; ".join(f"{key}: {reason}" for key, reason in errors.items()))
        self.errors = errors


def run_backfill(
    spark: SparkSession,
    store: Store,
    ranges: list[tuple[str, str]],
    created_at: Instant,
    min_rows: int = rules.MIN_TRAINING_ROWS,
    spec: ForestSpec = ForestSpec(),
) -> DataFrame:
    """Backfill from the stored readings and keep the models in the registry; returns their metrics.

    Some ranges at a time are fitted, evaluated, stored and released, so the driver holds no more than their models, and what
    is done stays when a later range fails. Repeated ranges count once. Ranges without a model, being empty, too
    small or pathological, are named by an error once all others are done.
    """
    wanted = list(dict.fromkeys(ranges))
    by_key = dict(zip(model_keys(spark, wanted), wanted))
    errors: dict[str, str] = {}
    done: list[tuple] = []
    for start in range(0, len(by_key), RANGES_PER_JOB):
        part = dict(list(by_key.items())[start : start + RANGES_PER_JOB])
        readings = _readings_of(spark, store, list(part.values()))
        known = survey_tagged(extract_ranges(readings, part), list(part), spec)
        for key, one in known.items():
            try:
                assert_enough(one.n_extracted, one.n_valid, min_rows)
            except NotEnoughRows as reason:
                errors[key] = str(reason)
                del part[key]
        if part:
            done += _fit_and_keep(readings, store, part, created_at, min_rows, spec, errors, known)
    if errors:
        raise BackfillFailed(errors)
    return spark.createDataFrame(done, METRICS)


def _readings_of(spark: SparkSession, store: Store, ranges: list[tuple[str, str]]) -> DataFrame:
    """Stored readings of the dates from the earliest start to the latest end; no other folders are listed."""
    dates = spark.createDataFrame(ranges, "start STRING, end STRING").agg(
        F.min(F.to_date(F.col("start").cast("timestamp"))).alias("first"),
        F.max(F.to_date(F.col("end").cast("timestamp"))).alias("last"),
    )
    row = dates.first()
    return store.readings.read_dates(spark, row["first"], row["last"])


def _fit_and_keep(
    readings: DataFrame,
    store: Store,
    ranges: dict[str, tuple[str, str]],
    created_at: Instant,
    min_rows: int,
    spec: ForestSpec,
    errors: dict[str, str],
    known: dict[str, Survey],
) -> list[tuple]:
    """Fit ranges that have enough rows and store the healthy models; returns the metrics of these."""
    result = _fit_ranges(readings, ranges, min_rows, spec, "row_id", known)
    try:
        rows = with_pathology(result.metrics).collect()
        for row in rows:
            if row["pathological"]:
                errors[row["model_id"]] = f"pathological model: anomaly rate {row['anomaly_rate']}"
            else:
                metrics = result.metrics.filter(F.col("model_id") == row["model_id"])
                save_model(store, result.fitted[row["model_id"]].forest, metrics, instant(created_at))
        return [tuple(row[name] for name in METRICS.names) for row in rows if not row["pathological"]]
    finally:
        result.discard()


def _fit_ranges(
    readings: DataFrame,
    ranges: dict[str, tuple[str, str]],
    min_rows: int,
    spec: ForestSpec,
    row_id: str,
    known: dict[str, Survey] | None = None,
) -> Backfill:
    fitted = fit_tagged(extract_ranges(readings, ranges, row_id), list(ranges), spec, min_rows, known)
    predictions = [with_prediction(one.scores, one.forest.threshold) for one in fitted.values()]
    metrics = health_score(reduce(DataFrame.unionByName, predictions), spec.contamination, by=("model_id",))
    # One row per range: computed here, so that they outlast the stored scores.
    rows = [tuple(row) for row in metrics.select(*METRICS.names).collect()]
    return Backfill(fitted, readings.sparkSession.createDataFrame(rows, METRICS))
