"""Model registry: versions, promotion decisions, and the model in production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetra.operators.forest import Forest, ForestSpec, assert_whole
from telemetra.rules import CHAMPION_SCORE
from telemetra.schemas import FOREST_NODES, MODELS, PROMOTIONS
from telemetra.tables import Store

PROMOTE, KEEP = "promote", "keep"


class UnknownModel(KeyError):
    """No stored model has this id."""


def _with_earlier_months(models: DataFrame) -> DataFrame:
    """Models with their month, and the number and best health of models of earlier months.

    The running totals go over one row for each month; the models themselves stay where they are.
    """
    dated = models.withColumn("_month", F.trunc("created_at", "month"))
    months = dated.groupBy("_month").agg(F.count(F.lit(1)).alias("n"), F.max("health_score").alias("best"))
    before = Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    earlier = months.select(
        F.col("_month").alias("_of"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_earlier"),
        F.max("best").over(before).alias("_best"),
    )
    return dated.join(earlier, F.col("_month").eqNullSafe(F.col("_of"))).drop("_of")


def versions(models: DataFrame) -> DataFrame:
    """Number the models by age: within their month, after those of earlier months."""
    age = Window.partitionBy("_month").orderBy("created_at", "model_id")
    version = (F.row_number().over(age) + F.col("_earlier")).cast("int")
    return _with_earlier_months(models).withColumn("version", version).select(*models.columns, "version")


def current_model(models: DataFrame, promotions: DataFrame) -> DataFrame:
    """The latest promoted model; no row before the first promotion."""
    latest = promotions.agg(F.max(F.struct("promoted_at", "model_id")).alias("latest")).select("latest.*")
    return models.join(latest, "model_id").select(*models.columns, "promoted_at")


def promotion_decision(
    metrics: DataFrame, models: DataFrame, promotions: DataFrame, fallback: float = CHAMPION_SCORE
) -> DataFrame:
    """Promote a candidate whose health is strictly above the production model's.

    Without a production model the candidate has to beat ``fallback``.
    """
    champion = current_model(models, promotions).agg(F.max("health_score"))
    return metrics.withColumn("champion_score", F.coalesce(champion.scalar(), F.lit(fallback))).withColumn(
        "decision", F.when(F.col("health_score") > F.col("champion_score"), PROMOTE).otherwise(KEEP)
    )


def promotion_history(models: DataFrame, fallback: float = CHAMPION_SCORE) -> DataFrame:
    """The decision on each model in the order of creation, each against the champion of its time.

    A promoted model is better than the one before, so the champion is the running maximum.
    """
    earlier = Window.partitionBy("_month").orderBy("created_at", "model_id").rowsBetween(Window.unboundedPreceding, -1)
    champion = F.greatest(F.max("health_score").over(earlier), F.col("_best"), F.lit(fallback))
    decided = (
        _with_earlier_months(models)
        .withColumn("champion_score", champion)
        .withColumn("decision", F.when(F.col("health_score") > F.col("champion_score"), PROMOTE).otherwise(KEEP))
    )
    return decided.select(*models.columns, "champion_score", "decision")


def save_forest(store: Store, forest: Forest, spark: SparkSession) -> None:
    """Store the node rows; the same model id is replaced."""
    nodes = forest.nodes.astype(object).where(forest.nodes.notna(), None)
    rows = [tuple(row) for row in nodes[FOREST_NODES.names].itertuples(index=False)]
    store.nodes.replace_partitions(spark.createDataFrame(rows, FOREST_NODES).coalesce(1))


def save_model(store: Store, forest: Forest, metrics: DataFrame, created_at: F.Column) -> None:
    """Store a forest and its registry row; ``metrics`` is its row of health_score."""
    save_forest(store, forest, metrics.sparkSession)
    entry = {
        "model_id": F.lit(forest.model_id),
        "created_at": created_at,
        "n_trees": F.lit(forest.spec.n_trees),
        "sample_size": F.lit(forest.sample_size),
        "max_samples": F.lit(forest.spec.max_samples),
        "seed": F.lit(forest.spec.seed).cast("long"),
        "features": F.lit(",".join(forest.spec.features)),
        "contamination": F.lit(forest.spec.contamination),
        "threshold": F.lit(forest.threshold),
    }
    store.models.replace_partitions(metrics.withColumns(entry).select(*MODELS.names))


def promote(store: Store, model_id: str, promoted_at: F.Column, spark: SparkSession) -> None:
    """Record that a model goes into production."""
    row = spark.range(1).select(F.lit(model_id).alias("model_id"), promoted_at.alias("promoted_at"))
    store.promotions.replace_partitions(row.select(*PROMOTIONS.names))


def load_forest(store: Store, spark: SparkSession, model_id: str) -> Forest:
    """Read a stored forest back; both reads touch one partition."""
    chosen = F.col("model_id") == model_id
    entry = store.models.read(spark).filter(chosen).first()
    if entry is None:
        raise UnknownModel(f"no model {model_id!r} in the registry")
    nodes = store.nodes.read(spark).filter(chosen).toArrow().to_pandas()
    spec = ForestSpec(
        entry["n_trees"], entry["max_samples"], entry["contamination"], entry["seed"], tuple(entry["features"].split(","))
    )
    forest = Forest(model_id, spec, entry["sample_size"], nodes, entry["threshold"])
    assert_whole(forest)
    return forest
