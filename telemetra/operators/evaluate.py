"""Evaluation of predictions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.rules import ANOMALY, CONTAMINATION, NORMAL


class PathologicalModel(ValueError):
    """A model that calls every row an anomaly, or none."""


def as_prediction(flag: Column) -> Column:
    """Boolean flag to -1 (anomaly) or 1."""
    return F.when(flag, ANOMALY).otherwise(NORMAL)


def health_score(predictions: DataFrame, contamination: float = CONTAMINATION, by: tuple[str, ...] = ()) -> DataFrame:
    """Anomaly rate and its closeness to the expected rate, over all rows or per group."""
    counted = predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("prediction") == ANOMALY).alias("n_anomalies"),
    )
    rate = F.try_divide("n_anomalies", "n_rows")
    return counted.withColumn("anomaly_rate", rate).withColumn(
        "health_score", 1.0 - F.abs(F.lit(contamination) - F.col("anomaly_rate"))
    )


def with_pathology(metrics: DataFrame) -> DataFrame:
    """Mark models that call every row an anomaly, or none."""
    extremes = [F.col("anomaly_rate") == rate for rate in (0.0, 1.0)]
    return metrics.withColumn("pathological", reduce(or_, extremes))


def assert_healthy(metrics: DataFrame) -> None:
    bad = with_pathology(metrics).filter("pathological").first()
    if bad is not None:
        raise PathologicalModel(f"anomaly rate is {bad['anomaly_rate']:.0%}; check data and contamination")


def label_eval(flagged: DataFrame, flag: Column, label: Column, by: tuple[str, ...] = ()) -> DataFrame:
    """Confusion matrix and the usual ratios of a boolean flag against a boolean label."""
    cells = flagged.groupBy(*by).agg(
        F.count_if(flag & label).alias("tp"),
        F.count_if(flag & ~label).alias("fp"),
        F.count_if(~flag & label).alias("fn"),
        F.count_if(~flag & ~label).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(name) for name in ("tp", "fp", "fn", "tn"))
    return cells.withColumns(
        {
            "accuracy": F.try_divide(tp + tn, tp + fp + fn + tn),
            "precision": F.try_divide(tp, tp + fp),
            "recall": F.try_divide(tp, tp + fn),
            "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
        }
    )


def compare_models(
    scored: DataFrame, champion: str, challenger: str, contamination: float = CONTAMINATION
) -> DataFrame:
    """Two models' predictions on the same rows, side by side in one row."""

    def rate(name: str) -> Column:
        return F.try_divide(F.count_if(F.col(name) == ANOMALY), F.count(F.lit(1)))

    rates = scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(champion) == F.col(challenger)).alias("n_agreeing"),
        rate(champion).alias("champion_rate"),
        rate(challenger).alias("challenger_rate"),
    )
    health = {
        f"{role}_health": 1.0 - F.abs(F.lit(contamination) - F.col(f"{role}_rate"))
        for role in ("champion", "challenger")
    }
    better = F.when(F.col("challenger_health") > F.col("champion_health"), "challenger").otherwise("champion")
    return rates.withColumns(health).withColumn("better", better)
