"""The daily jobs: summary, and model training with its gates."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.functions.times import Instant, instant
from telemetra.operators import registry
from telemetra.operators.evaluate import health_score
from telemetra.operators.forest import Forest, ForestSpec, fit, with_prediction
from telemetra.operators.gates import is_open, new_data_ready, summary_ready
from telemetra.operators.partials import measures, summary_from_partials
from telemetra.operators.summary import daily_summary, summary_report
from telemetra.operators.training import extract_recent
from telemetra.operators.upsert import assert_unique
from telemetra.schemas import SUMMARY_KEYS
from telemetra.tables import Store


class NotReady(RuntimeError):
    """A gate is closed; the caller may try again later."""


@dataclass(frozen=True)
class Trained:
    forest: Forest
    health_score: float
    decision: str


def _days(spark: SparkSession, as_of: Instant) -> tuple[date, date]:
    """The dates that the 24 hours before ``as_of`` touch; only their folders are listed."""
    last = spark.range(1).select(F.to_date(instant(as_of)).alias("day")).first()["day"]
    return last - timedelta(days=1), last


def hourly_summary(spark: SparkSession, store: Store, as_of: Instant) -> DataFrame:
    """Summary of the last 24 hours from the stored statistics of each hour, and readings of at most two hours."""
    days = _days(spark, as_of)
    return summary_from_partials(store.hourly.read_dates(spark, *days), as_of, store.readings.read_dates(spark, *days))


def run_summary(spark: SparkSession, store: Store, as_of: Instant, from_hours: bool = False) -> DataFrame:
    """Summarise the last 24 hours, merge into the summary table, and report the date's rows.

    ``from_hours`` takes the statistics that the ETL has stored by hour; else all readings of the window are read.
    """
    today = F.to_date(instant(as_of))
    days = _days(spark, as_of)
    if from_hours:
        new = hourly_summary(spark, store, as_of)
    else:
        new = daily_summary(store.readings.read_dates(spark, *days), store.anomalies.read_dates(spark, *days), as_of)
    store.upsert_summary(new, today)
    summary = store.summary.read(spark)
    assert_unique(summary.filter(F.col("summary_date") == today), SUMMARY_KEYS)
    return summary_report(summary, as_of)


def rebuild_hours(spark: SparkSession, store: Store, first: date, last: date) -> None:
    """Store the statistics by hour of readings that were stored without them; what is there of these dates is replaced."""
    readings = store.readings.read_dates(spark, first, last).filter("event_time IS NOT NULL")
    hour = F.date_trunc("hour", "event_time").alias("event_time")
    by = ("event_date", "batch_id", "sensor_id")
    store.hourly.replace_partitions(readings.groupBy(*by, hour).agg(*measures()))


def _recent_readings(spark: SparkSession, store: Store, as_of: Instant) -> DataFrame:
    """Readings of the dates that a window of 24 hours before ``as_of``, without an upper end, touches."""
    return store.readings.read_dates(spark, _days(spark, as_of)[0])


def check_gates(spark: SparkSession, store: Store, as_of: Instant) -> None:
    if not is_open(new_data_ready(_recent_readings(spark, store, as_of), as_of)):
        raise NotReady("fewer than the needed readings in the last 24 hours")
    if not is_open(summary_ready(store.summary.read(spark), as_of)):
        raise NotReady("no summary for this date yet")


def run_training(
    spark: SparkSession, store: Store, model_id: str, as_of: Instant, spec: ForestSpec = ForestSpec()
) -> Trained:
    """Gates, extraction, validation, fit, evaluation, registry entry and promotion decision."""
    check_gates(spark, store, as_of)
    extracted = extract_recent(_recent_readings(spark, store, as_of), as_of)
    fitted = fit(extracted, model_id, spec)
    forest = fitted.forest
    with fitted.stage:
        measured = health_score(with_prediction(fitted.scores, forest.threshold), spec.contamination)
        # One row, which the decision and the registry both use.
        metrics = spark.createDataFrame(measured.collect(), measured.schema)
    models, promotions = store.models.read(spark), store.promotions.read(spark)
    outcome = registry.promotion_decision(metrics, models, promotions).first()
    registry.save_model(store, forest, metrics, instant(as_of))
    if outcome["decision"] == registry.PROMOTE:
        registry.promote(store, model_id, instant(as_of), spark)
    return Trained(forest, outcome["health_score"], outcome["decision"])
