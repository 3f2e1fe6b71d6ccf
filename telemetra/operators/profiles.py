"""Hourly series, next-hour forecast, sensor profiles and groups, and a supervised classifier."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.functions.air import is_anomaly, is_labelled
from telemetra.functions.times import Instant, instant
from telemetra.operators.learned import Learned
from telemetra.rules import SEED
from telemetra.schemas import FEATURES
from telemetra.sources.scans import materialise

LAGS = (1, 2, 3)
HASH_BUCKETS = 100
FORECAST, CLUSTERS, CLASSIFIER = "forecast", "clusters", "classifier"
FORECAST_INPUTS = ("current", *[f"lag_{lag}" for lag in LAGS], "day_sin", "day_cos")


class NothingToLearn(ValueError):
    """No row to train on."""


def hourly(readings: DataFrame, value: str = "pm2_5") -> DataFrame:
    """Hourly mean per sensor; ``hour`` counts whole hours since the epoch."""
    hour = F.floor(F.unix_seconds("event_time") / 3600).alias("hour")
    return readings.groupBy("sensor_id", hour).agg(
        F.avg(value).alias("current"), F.count(F.lit(1)).alias("n_readings")
    )


def hourly_lags(readings: DataFrame, value: str = "pm2_5", lags: tuple[int, ...] = LAGS) -> DataFrame:
    """Hourly mean with the means of earlier hours and of the next hour; a missing hour gives NULL.

    The window works on hourly rows, so a sensor with very many readings is not a large group.
    """
    by_hour = Window.partitionBy("sensor_id").orderBy("hour")

    def at(offset: int) -> Column:
        return F.first("current").over(by_hour.rangeBetween(offset, offset))

    return hourly(readings, value).withColumns({f"lag_{lag}": at(-lag) for lag in lags} | {"next_hour": at(1)})


def persistence_error(lagged: DataFrame) -> DataFrame:
    """Error of forecasting that the next hour equals the current one."""
    return forecast_error(lagged, F.col("current"))


def forecast_error(lagged: DataFrame, forecast: Column) -> DataFrame:
    error = forecast - F.col("next_hour")
    return lagged.filter(F.col("next_hour").isNotNull()).agg(
        F.count(F.lit(1)).alias("n_hours"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def forecast_rows(readings: DataFrame, value: str = "pm2_5") -> DataFrame:
    """What the forecast reads, one row for each sensor and hour with readings.

    A missing earlier hour takes the value of the hour after it. ``next_hour`` is NULL where it is still unknown, as after
    the last hour of each sensor.
    """
    lagged = hourly_lags(readings, value)
    nearest = "current"
    for lag in LAGS:
        lagged = lagged.withColumn(f"lag_{lag}", F.coalesce(f"lag_{lag}", nearest))
        nearest = f"lag_{lag}"
    day_angle = F.col("hour") % 24 * F.lit(2 * 3.141592653589793 / 24)
    return lagged.withColumns({"day_sin": F.sin(day_angle), "day_cos": F.cos(day_angle)})


def fit_forecast(rows: DataFrame, train_until: Instant) -> Learned:
    """Linear forecast of the next hour from ``forecast_rows`` whose next hour lies before ``train_until``, read several times."""
    boundary = F.floor(F.unix_seconds(instant(train_until)) / 3600)
    known = F.col("next_hour").isNotNull() & F.col("current").isNotNull()
    training = rows.filter(known & (F.col("hour") + 1 < boundary))
    if training.isEmpty():
        raise NothingToLearn("no pair of consecutive hours before the boundary")
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(FORECAST_INPUTS), outputCol="inputs", handleInvalid="keep"),
            LinearRegression(featuresCol="inputs", labelCol="next_hour", predictionCol="forecast", regParam=0.01),
        ]
    ).fit(training)
    fitted = model.stages[-1].summary
    return Learned(FORECAST, model, FORECAST_INPUTS, fitted.numInstances, {"rmse": fitted.rootMeanSquaredError, "mae": fitted.meanAbsoluteError})


def apply_forecast(rows: DataFrame, learned: Learned) -> DataFrame:
    """The rows with ``forecast``; an hour without a value has none."""
    forecast = F.when(~F.isnan("forecast"), F.col("forecast")).alias("forecast")
    return learned.model.transform(rows).select("sensor_id", "hour", "current", "next_hour", forecast)


def forecast_next_hour(readings: DataFrame, train_until: Instant, value: str = "pm2_5") -> DataFrame:
    """Linear forecast of the next hour, fitted before ``train_until`` and applied to every hour from there on."""
    rows = materialise(forecast_rows(readings, value), "forecast").until_exit()
    boundary = F.floor(F.unix_seconds(instant(train_until)) / 3600)
    return apply_forecast(rows.filter(F.col("hour") >= boundary), fit_forecast(rows, train_until))


def sensor_profile(readings: DataFrame) -> DataFrame:
    """Measurement pattern of each sensor."""
    return readings.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("n_readings"),
        *[F.avg(name).alias(f"mean_{name}") for name in FEATURES],
        *[F.stddev_samp(name).alias(f"std_{name}") for name in FEATURES],
        F.avg(F.coalesce(is_anomaly(F.col), F.lit(False)).cast("double")).alias("anomaly_share"),
    )


def _present(names: Sequence[str]) -> Column:
    """Whether a row has a number in every one of some columns."""
    return reduce(and_, [F.col(name).isNotNull() & ~F.isnan(F.col(name).cast("double")) for name in names])


def fit_clusters(profile: DataFrame, k: int = 3, seed: int = SEED) -> Learned:
    """Groups of sensors of similar pattern, from ``sensor_profile``, read several times. Incomplete profiles are left out."""
    inputs = tuple(name for name in profile.columns if name not in ("sensor_id", "n_readings"))
    complete = profile.filter(_present(inputs))
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(inputs), outputCol="raw", handleInvalid="keep"),
            StandardScaler(inputCol="raw", outputCol="scaled", withMean=True),
            KMeans(featuresCol="scaled", predictionCol="cluster", k=k, seed=seed),
        ]
    ).fit(complete)
    fitted = model.stages[-1].summary
    return Learned(CLUSTERS, model, inputs, sum(fitted.clusterSizes), {"cost": fitted.trainingCost, "k": float(fitted.k)})


def apply_clusters(profile: DataFrame, learned: Learned) -> DataFrame:
    """The group of each sensor; a sensor without a full profile is in none (NULL)."""
    cluster = F.when(_present(learned.inputs), F.col("cluster")).alias("cluster")
    return learned.model.transform(profile).select("sensor_id", "n_readings", cluster)


def sensor_clusters(readings: DataFrame, k: int = 3, seed: int = SEED) -> DataFrame:
    """Group sensors of similar pattern; a sensor without a full profile is in no group (NULL)."""
    profile = materialise(sensor_profile(readings), "profile").until_exit()
    return apply_clusters(profile, fit_clusters(profile, k, seed))


def _is_held_out(row_id: str, test_percent: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(row_id, F.lit(seed)), F.lit(HASH_BUCKETS)) < test_percent


def fit_classifier(readings: DataFrame, row_id: str = "row_id", test_percent: int = 20, seed: int = SEED) -> Learned:
    """Learn the truth label from the features of the rows that are not held out, by hash of their key.

    Labelled anomalies are rare, so both classes get the same total weight.
    """
    label = is_labelled(F.col("is_true_anomaly")).cast("double").alias("label")
    rows = readings.filter(_present(FEATURES) & ~_is_held_out(row_id, test_percent, seed)).select(*FEATURES, label)
    with materialise(rows, "classifier") as training:
        totals = training.rows.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive")).first()
        if not totals["n"] or totals["positive"] in (0.0, totals["n"]):
            raise NothingToLearn("training needs rows of both labels")
        share = totals["positive"] / totals["n"]
        weight = F.when(F.col("label") == 1.0, 0.5 / share).otherwise(0.5 / (1 - share))
        model = Pipeline(
            stages=[
                VectorAssembler(inputCols=list(FEATURES), outputCol="inputs", handleInvalid="keep"),
                RandomForestClassifier(
                    featuresCol="inputs", labelCol="label", weightCol="weight", numTrees=20, maxDepth=5, seed=seed
                ),
            ]
        ).fit(training.rows.withColumn("weight", weight))
    return Learned(CLASSIFIER, model, FEATURES, totals["n"], {"positive_share": share})


def apply_classifier(readings: DataFrame, learned: Learned) -> DataFrame:
    """The readings, of a batch or a stream, with flag and probability; both are NULL where a feature is missing."""
    complete = _present(learned.inputs)
    found = learned.model.transform(readings)
    flag = F.when(complete, F.col("prediction") == 1.0).alias("is_flagged")
    probability = F.when(complete, F.element_at(vector_to_array("probability"), 2)).alias("probability")
    return found.select(*readings.columns, flag, probability)


def classify_anomalies(
    readings: DataFrame, row_id: str = "row_id", test_percent: int = 20, seed: int = SEED
) -> DataFrame:
    """Learn the truth label from the features; returns the held-out rows with label and flag."""
    learned = fit_classifier(readings, row_id, test_percent, seed)
    held_out = readings.filter(_present(FEATURES) & _is_held_out(row_id, test_percent, seed))
    label = is_labelled(F.col("is_true_anomaly")).alias("is_labelled")
    return apply_classifier(held_out.select(row_id, *FEATURES, label), learned).drop(*FEATURES)
