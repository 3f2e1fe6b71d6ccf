"""Every registered query: (spark, folder of the tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.compaction import compact, sweep
from telemetra.functions.air import aqi_category, heat_index, is_anomaly, is_labelled
from telemetra.functions.keys import model_key
from telemetra.functions.numeric import round_numeric
from telemetra.functions.times import event_time, instant, rolling_window
from telemetra.operators import enrich, evaluate, forest, gates, partials, profiles, registry, summary, training
from telemetra.operators.clean import clean, quality_report, rejected
from telemetra.operators.learned import Shelf
from telemetra.operators.upsert import duplicate_keys, upsert
from telemetra.plans import daily
from telemetra.plans.backfill import backfill
from telemetra.queries import fixture
from telemetra.queries.fixture import AS_OF, RANGE
from telemetra.schemas import FEATURES, SUMMARY_KEYS
from telemetra.session import workspace
from telemetra.sinks.batches import Sink, table_sink
from telemetra.sinks.unique import Guard
from telemetra.sources.messages import parse
from telemetra.sources.scans import materialise, remove_at_exit
from telemetra.streaming.etl import anomalies_shape, file_sinks, readings_shape, run_etl, transform
from telemetra.streaming.rolling import rolling_summary
from telemetra.streaming.scoring import score_messages
from telemetra.tables import Store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SENSOR, SENSOR_WINDOW = "CAP_007", ("2024-01-09 20:15:00", "2024-01-10 11:00:00")
OFF_HOUR, ONCE_WITHIN, ROLLING_DELAY = "2024-01-14 12:34:56", "1 hour", "1 hour"
EARLY_SUMMARY, LATE_SUMMARY = "2024-01-14 01:00:00", "2024-01-14 13:00:00"
BACKFILL_RANGES = [
    ("2024-01-01 00:00:00", "2024-01-10 23:59:59"),
    ("2024-01-11 00:00:00", "2024-01-20 23:59:59"),
    ("2024-01-21 00:00:00", "2024-01-31 23:59:59"),
]
FORECAST_BOUNDARY = "2024-01-24 00:00:00"
MAX_SHIFT = 0.01
RAW_COLUMNS = ("sensor_id", "lat", "lon", *FEATURES, "status", "is_true_anomaly")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: round_numeric(F.col(name), digits) for name in names})


def _flag() -> Column:
    return F.coalesce(is_anomaly(F.col), F.lit(False))


def _label() -> Column:
    return is_labelled(F.col("is_true_anomaly"))


# --- sources and messages


def _nullable_as_double(df: DataFrame) -> DataFrame:
    """Clients fetch an integer column with NULLs in different types; a double is the same for all."""
    return df.withColumn("humidity", F.col("humidity").cast("double"))


def _flat_message(df: DataFrame) -> DataFrame:
    flat = df.select("row_id", "sensor_id", "timestamp", "location.*", "measurements.*", "status", "is_true_anomaly")
    return _nullable_as_double(flat)


@query
def s_parse_json(spark, sf_dir):
    return _flat_message(parse(fixture.messages(spark, sf_dir)))


@query
def s_parse_malformed(spark, sf_dir):
    """Damaged payloads among good ones: every row stays, damaged ones with NULL fields."""
    kind, text = F.col("row_id") % 6, F.col("value").cast("string")
    damaged = (
        F.when(kind == 0, F.substring(text, 1, 40))
        .when(kind == 1, "hello")
        .when(kind == 2, "")
        .when(kind == 3, F.concat(F.lit("["), F.lit('{"sensor_id":"z"}'), F.lit("]")))
        .when(kind == 4, text)
    )
    messages = fixture.messages(spark, sf_dir).withColumn("value", damaged.cast("binary"))
    return _flat_message(parse(messages)).select("row_id", "sensor_id", "timestamp", "pm2_5", "humidity", "status")


@query
def s_processed_json(spark, sf_dir):
    return enrich.to_messages(fixture.enriched(spark, sf_dir), enrich.PROCESSED_FIELDS)


@query
def s_anomaly_json(spark, sf_dir):
    return enrich.to_messages(enrich.detect(fixture.enriched(spark, sf_dir)), enrich.ANOMALY_FIELDS)


def _folder(spark: SparkSession, name: str) -> str:
    """A folder in the shared one for what a query leaves to be read; it goes when the process ends."""
    root = workspace(spark, name)
    remove_at_exit(spark, root)
    return root


def _ingest(
    spark: SparkSession,
    sf_dir: str,
    sinks: Callable[[Store, str], list[Sink]],
    arriving: Callable[[DataFrame], DataFrame] = lambda messages: messages,
    once_within: str | None = None,
) -> Store:
    """Run the streaming ETL over the whole events table; its tables stay until the process ends."""
    root = _folder(spark, "ingest")
    store = Store(f"{root}/tables")
    for stored in (store.readings, store.anomalies, store.hourly):
        stored.create(spark)
    stream = arriving(fixture.messages_of(fixture.event_stream(spark, sf_dir)))
    etl = run_etl(
        stream, sinks(store, f"{root}/messages"), f"{root}/checkpoint", processed_at=instant(AS_OF), once_within=once_within
    )
    etl.awaitTermination()
    return store


@query
def s_stream_ingest(spark, sf_dir):
    """The readings table, written beside the anomalies table and both kinds of message."""
    store = _ingest(spark, sf_dir, file_sinks)
    return store.readings.read(spark).drop("event_date", "batch_id", "processed_at")


@query
def s_stream_anomalies(spark, sf_dir):
    """The anomalies table, written alone."""
    store = _ingest(spark, sf_dir, lambda store, _: [table_sink(store.anomalies, anomalies_shape)])
    return store.anomalies.read(spark).drop("event_date", "batch_id", "processed_at")


@query
def s_stream_once(spark, sf_dir):
    """The readings that remain of a stream in which every third message arrives twice."""

    def some_twice(messages: DataFrame) -> DataFrame:
        times = F.when(F.col("row_id") % 3 == 0, 2).otherwise(1)
        return messages.withColumn("time", F.explode(F.sequence(F.lit(1), times))).drop("time")

    store = _ingest(spark, sf_dir, lambda store, _: [table_sink(store.readings, readings_shape)], some_twice, ONCE_WITHIN)
    return store.readings.read(spark).select("sensor_id", "event_time")


@query
def u_unique_append(spark, sf_dir):
    """Readings stored in two batches, of which the second repeats the first: sensor and time are unique, and the first one stays."""
    store = Store(_folder(spark, "unique"))
    store.readings.create(spark)
    sink = Guard(store.readings).sink(readings_shape)
    messages = fixture.messages(spark, sf_dir)
    for batch_id, rows in enumerate((messages.filter("row_id % 2 = 0"), messages)):
        sink(transform(rows, instant(AS_OF)), batch_id)
    return store.readings.read(spark).select("sensor_id", "event_time", "batch_id")


@query
def s_rolling_summary(spark, sf_dir):
    """Summaries of all windows of a day, one ending each hour, that the stream has closed."""
    root = _folder(spark, "rolling")
    enriched = transform(fixture.messages_of(fixture.event_stream(spark, sf_dir)), instant(AS_OF))
    rolling = rolling_summary(enriched, ROLLING_DELAY)
    sink = rolling.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
    sink.outputMode("append").trigger(availableNow=True).start(f"{root}/windows").awaitTermination()
    return spark.read.schema(rolling.schema).parquet(f"{root}/windows")


# --- filters and projections


@query
def f_clean(spark, sf_dir):
    return clean(fixture.raw(spark, sf_dir)).select("row_id", "event_time", *RAW_COLUMNS)


@query
def f_rejected(spark, sf_dir):
    return _nullable_as_double(rejected(fixture.raw(spark, sf_dir)).select("row_id", "event_time", *RAW_COLUMNS))


@query
def f_anomalies(spark, sf_dir):
    return enrich.detect(fixture.enriched(spark, sf_dir)).select("row_id", "sensor_id", "measurements.*")


@query
def f_rolling_24h(spark, sf_dir):
    return rolling_window(fixture.readings(spark, sf_dir), AS_OF).select("row_id", "sensor_id", "event_time")


@query
def p_enrich(spark, sf_dir):
    return fixture.enriched(spark, sf_dir).select(
        "row_id", "sensor_id", "timestamp", "measurements.*", "aqi_category", "heat_index"
    )


@query
def p_flatten_readings(spark, sf_dir):
    return enrich.flatten_readings(fixture.enriched(spark, sf_dir), carry=("row_id",)).drop("processed_at")


@query
def p_flatten_anomalies(spark, sf_dir):
    flat = enrich.flatten_anomalies(enrich.detect(fixture.enriched(spark, sf_dir)), carry=("row_id",))
    return flat.drop("processed_at")


@query
def p_anomaly_reason(spark, sf_dir):
    return enrich.detect(fixture.enriched(spark, sf_dir)).select("row_id", "anomaly_reason")


@query
def p_anomaly_severity(spark, sf_dir):
    return enrich.detect(fixture.enriched(spark, sf_dir)).select("row_id", "severity")


@query
def p_debug_projection(spark, sf_dir):
    return enrich.debug_projection(fixture.enriched(spark, sf_dir))


@query
def q_quality_report(spark, sf_dir):
    return quality_report(fixture.raw(spark, sf_dir))


# --- scalar functions, over all raw rows


@query
def x_event_time(spark, sf_dir):
    kind, text = F.col("row_id") % 6, F.col("timestamp")
    written = (
        F.when(kind == 0, F.concat(text, F.lit("Z")))
        .when(kind == 1, F.concat(text, F.lit("+02:00")))
        .when(kind == 2, F.substring(text, 1, 10))
        .when(kind == 3, "garbage")
        .when(kind == 4, "")
        .otherwise(text)
    )
    return fixture.parsed(spark, sf_dir).select("row_id", event_time(written).alias("event_time"))


@query
def x_round_numeric(spark, sf_dir):
    third = F.col("pm2_5") / 3
    return fixture.raw(spark, sf_dir).select(
        "row_id", round_numeric(third, 2).alias("two_digits"), round_numeric(third, 1).alias("one_digit")
    )


@query
def x_heat_index(spark, sf_dir):
    heat = heat_index(F.col("temperature"), F.col("humidity"))
    return fixture.raw(spark, sf_dir).select("row_id", heat.alias("heat_index"))


@query
def x_aqi_category(spark, sf_dir):
    return fixture.raw(spark, sf_dir).select("row_id", aqi_category(F.col("pm2_5")).alias("aqi_category"))


@query
def x_model_key(spark, sf_dir):
    start = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")
    end = F.date_format(F.col("event_time") + F.expr("INTERVAL 24 HOURS"), "yyyy-MM-dd HH:mm:ss")
    return fixture.raw(spark, sf_dir).select("row_id", model_key(start, end).alias("model_key"))


# --- aggregations, joins and the daily summary


def _rounded_stats(df: DataFrame) -> DataFrame:
    return _rounded(df, *[f"avg_{name}" for name in FEATURES])


@query
def a_sensor_stats(spark, sf_dir):
    return _rounded_stats(summary.sensor_stats(fixture.readings(spark, sf_dir)))


@query
def a_anomaly_counts(spark, sf_dir):
    return summary.anomaly_counts(fixture.anomalies(spark, sf_dir))


@query
def a_aqi_frequency(spark, sf_dir):
    return summary.aqi_frequency(fixture.readings(spark, sf_dir))


@query
def a_dominant_aqi(spark, sf_dir):
    return summary.dominant_aqi(fixture.readings(spark, sf_dir))


@query
def j_readings_anomalies(spark, sf_dir):
    """All readings' statistics beside the anomaly counts of the window: some sensors count zero."""
    stats = summary.sensor_stats(fixture.readings(spark, sf_dir))
    counts = summary.anomaly_counts(rolling_window(fixture.anomalies(spark, sf_dir), AS_OF))
    return _rounded_stats(summary.with_anomaly_counts(stats, counts))


@query
def j_readings_dominant(spark, sf_dir):
    readings = fixture.readings(spark, sf_dir)
    dominant = summary.dominant_aqi(rolling_window(readings, AS_OF))
    return _rounded_stats(summary.with_dominant(summary.sensor_stats(readings), dominant))


def _summary(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    return summary.daily_summary(fixture.readings(spark, sf_dir), fixture.anomalies(spark, sf_dir), as_of)


@query
def a_daily_summary(spark, sf_dir):
    return _summary(spark, sf_dir, AS_OF)


@query
def a_summary_report(spark, sf_dir):
    return summary.summary_report(_summary(spark, sf_dir, AS_OF), AS_OF)


@query
def a_summary_size(spark, sf_dir):
    return summary.summary_size(_summary(spark, sf_dir, AS_OF), AS_OF)


@query
def a_hourly_partials(spark, sf_dir):
    hourly = partials.hourly_partials(fixture.readings(spark, sf_dir))
    return _rounded(hourly, *[f"sum_{name}" for name in FEATURES])


def _from_hours(spark: SparkSession, sf_dir: str, as_of: str) -> DataFrame:
    """The summary from what the streaming ETL has stored of each hour."""
    store = _ingest(spark, sf_dir, lambda store, _: file_sinks(store, hourly=True))
    return daily.hourly_summary(spark, store, as_of)


@query
def a_summary_from_hours(spark, sf_dir):
    return _from_hours(spark, sf_dir, AS_OF)


@query
def a_summary_off_hour(spark, sf_dir):
    """The window begins and ends within an hour, so the readings of two hours are needed."""
    return _from_hours(spark, sf_dir, OFF_HOUR)


@query
def u_summary_upsert(spark, sf_dir):
    """The later run replaces its sensors' rows; it is stored first, since the merge reads it twice."""
    new = materialise(_summary(spark, sf_dir, LATE_SUMMARY), "summary").until_exit()
    return upsert(_summary(spark, sf_dir, EARLY_SUMMARY), new, SUMMARY_KEYS)


@query
def u_uniqueness_check(spark, sf_dir):
    both = _summary(spark, sf_dir, EARLY_SUMMARY).unionByName(_summary(spark, sf_dir, LATE_SUMMARY))
    return duplicate_keys(both, SUMMARY_KEYS)


@query
def u_versioned_upsert(spark, sf_dir):
    """Both runs merged into the stored summary table, each as a version of its own."""
    store = Store(_folder(spark, "summaries"))
    for as_of in (EARLY_SUMMARY, LATE_SUMMARY):
        store.upsert_summary(_summary(spark, sf_dir, as_of), F.to_date(instant(as_of)))
    return store.summary.read(spark)


def _compacted(spark: SparkSession, sf_dir: str) -> Store:
    """The readings that the ETL has stored, with the dates before as_of packed and their batch folders removed."""
    store = _ingest(spark, sf_dir, lambda store, _: [table_sink(store.readings, readings_shape)])
    compact(spark, store.readings, date.fromisoformat(AS_OF[:10]))
    sweep(spark, store.readings)
    return store


@query
def s_compacted_readings(spark, sf_dir):
    """All readings, of packed dates and of others."""
    return _compacted(spark, sf_dir).readings.read(spark).drop("event_date", "batch_id", "processed_at")


@query
def f_sensor_window(spark, sf_dir):
    """A sensor's readings of a few hours, from the packed files that may hold them."""
    found = _compacted(spark, sf_dir).readings.read_window(spark, *SENSOR_WINDOW, SENSOR)
    return found.select("row_id", "sensor_id", "event_time", "pm2_5")


# --- gates


@query
def g_new_data_ready(spark, sf_dir):
    return gates.new_data_ready(fixture.readings(spark, sf_dir), AS_OF)


@query
def g_summary_ready(spark, sf_dir):
    return gates.summary_ready(_summary(spark, sf_dir, AS_OF), AS_OF)


@query
def g_retrain_needed(spark, sf_dir):
    readings = fixture.readings(spark, sf_dir)
    return gates.retrain_needed(
        training.extract_range(readings, *RANGE), training.extract_recent(readings, AS_OF), MAX_SHIFT
    )


# --- model


@query
def m_extract_24h(spark, sf_dir):
    return training.extract_recent(fixture.readings(spark, sf_dir), AS_OF)


@query
def m_extract_range(spark, sf_dir):
    return training.extract_range(fixture.readings(spark, sf_dir), *RANGE)


@query
def m_validate(spark, sf_dir):
    return training.validate(_all_features(spark, sf_dir))


@query
def m_validation_counts(spark, sf_dir):
    return training.row_counts(_all_features(spark, sf_dir))


def _all_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.readings(spark, sf_dir).select("row_id", *FEATURES)


def _fit(spark: SparkSession, sf_dir: str) -> forest.Fitted:
    fitted = forest.fit(_all_features(spark, sf_dir), "all")
    fitted.stage.until_exit()
    return fitted


def _rates(metrics: DataFrame) -> DataFrame:
    """The exact threshold fixes the rates, but for the rare rows that share the score at the threshold."""
    return _rounded(metrics.drop("n_anomalies"), "anomaly_rate", "health_score", digits=3)


@query
def m_forest_fit(spark, sf_dir):
    """Node rows of a forest over all valid rows."""
    extracted, spec = _all_features(spark, sf_dir), forest.ForestSpec()
    known = forest.survey({"all": extracted}, spec)["all"]
    drawn = forest.candidates(training.validate(extracted), "all", known, spec)
    return _rounded(forest.grow(forest.samples(drawn, spec), spec), "threshold", "path_length", digits=9)


def _predicted(fitted: forest.Fitted) -> DataFrame:
    return forest.with_prediction(fitted.scores, fitted.forest.threshold)


@query
def m_forest_score(spark, sf_dir):
    return _rounded(_predicted(_fit(spark, sf_dir)).select("row_id", "score", "prediction"), "score", digits=9)


@query
def m_forest_health(spark, sf_dir):
    fitted = _fit(spark, sf_dir)
    return _rates(evaluate.health_score(_predicted(fitted))).withColumn("threshold", F.lit(round(fitted.forest.threshold, 9)))


@query
def m_backfill(spark, sf_dir):
    result = backfill(fixture.readings(spark, sf_dir), BACKFILL_RANGES)
    result.discard()
    thresholds = [(key, round(fitted.forest.threshold, 9)) for key, fitted in result.fitted.items()]
    return _rates(result.metrics).join(spark.createDataFrame(thresholds, "model_id STRING, threshold DOUBLE"), "model_id")


@query
def d_stream_scoring(spark, sf_dir):
    """The whole table, arriving as a stream of messages, scored by a forest fitted on it."""
    fitted = _fit(spark, sf_dir)
    root = _folder(spark, "scoring")
    stream = fixture.messages_of(fixture.event_stream(spark, sf_dir))
    scored = score_messages(stream, fitted.forest).select("row_id", "sensor_id", "score", "prediction")
    scored.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").trigger(
        availableNow=True
    ).start(f"{root}/scores").awaitTermination()
    return _rounded(spark.read.schema(scored.schema).parquet(f"{root}/scores"), "score", digits=9)


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stand-in models for every reading: its truth label, and the rule-based flag."""
    return fixture.readings(spark, sf_dir).select(
        "row_id",
        "sensor_id",
        "event_time",
        evaluate.as_prediction(_label()).alias("by_label"),
        evaluate.as_prediction(_flag()).alias("by_rule"),
    )


def _by_source(spark: SparkSession, sf_dir: str, *carry: Column) -> DataFrame:
    return _predictions(spark, sf_dir).select(
        *carry, F.expr("stack(2, 'label', by_label, 'rule', by_rule) AS (source, prediction)")
    )


@query
def m_health_score(spark, sf_dir):
    return evaluate.health_score(_by_source(spark, sf_dir), by=("source",))


@query
def m_pathological_guard(spark, sf_dir):
    """One model per sensor and hour: small groups reach the rates 0 and 1."""
    hour = F.date_trunc("hour", "event_time").alias("hour")
    predictions = _predictions(spark, sf_dir).select("sensor_id", hour, F.col("by_rule").alias("prediction"))
    return evaluate.with_pathology(evaluate.health_score(predictions, by=("sensor_id", "hour")))


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A candidate per day and source, with the health its predictions have on that day."""
    day = F.date_trunc("day", "event_time")
    model_id = F.concat_ws("_", "source", F.date_format("day", "yyyy-MM-dd"))
    by_day = evaluate.health_score(_by_source(spark, sf_dir, day.alias("day")), by=("day", "source"))
    return by_day.select(
        model_id.alias("model_id"),
        (F.col("day") + F.expr("INTERVAL 24 HOURS")).alias("created_at"),
        "n_rows",
        "anomaly_rate",
        "health_score",
    )


def _promotions(models: DataFrame) -> DataFrame:
    promoted = registry.promotion_history(models).filter(F.col("decision") == registry.PROMOTE)
    return promoted.select("model_id", F.col("created_at").alias("promoted_at"))


@query
def m_promotion_history(spark, sf_dir):
    return registry.promotion_history(_models(spark, sf_dir))


@query
def m_promotion_decision(spark, sf_dir):
    """Candidates created after as_of, against the model that is in production at as_of."""
    models = _models(spark, sf_dir)
    known = models.filter(F.col("created_at") <= instant(AS_OF))
    later = models.filter(F.col("created_at") > instant(AS_OF))
    return registry.promotion_decision(later, known, _promotions(known))


@query
def m_current_model(spark, sf_dir):
    models = _models(spark, sf_dir)
    return registry.current_model(models, _promotions(models))


@query
def m_model_versions(spark, sf_dir):
    return registry.versions(_models(spark, sf_dir))


@query
def m_champion_challenger(spark, sf_dir):
    return evaluate.compare_models(_predictions(spark, sf_dir), "by_rule", "by_label")


# --- labels, forecast, profiles


@query
def d_label_eval(spark, sf_dir):
    return evaluate.label_eval(fixture.readings(spark, sf_dir), _flag(), _label(), by=("sensor_id",))


@query
def d_classifier(spark, sf_dir):
    return profiles.classify_anomalies(fixture.readings(spark, sf_dir))


@query
def d_hourly_lags(spark, sf_dir):
    lagged = profiles.hourly_lags(fixture.readings(spark, sf_dir))
    return _rounded(lagged, "current", "lag_1", "lag_2", "lag_3", "next_hour")


@query
def d_forecast_persistence(spark, sf_dir):
    return _rounded(profiles.persistence_error(profiles.hourly_lags(fixture.readings(spark, sf_dir))), "mae", "rmse")


@query
def d_forecast_h1(spark, sf_dir):
    return profiles.forecast_next_hour(fixture.readings(spark, sf_dir), FORECAST_BOUNDARY)


@query
def d_sensor_profile(spark, sf_dir):
    profile = profiles.sensor_profile(fixture.readings(spark, sf_dir))
    return _rounded(profile, *[name for name in profile.columns if name not in ("sensor_id", "n_readings")])


@query
def d_sensor_clusters(spark, sf_dir):
    return profiles.sensor_clusters(fixture.readings(spark, sf_dir))


@query
def d_saved_models(spark, sf_dir):
    """Forecast, groups and classifier: fitted, kept on a shelf, loaded and applied again, with what differs from before."""
    readings = fixture.readings(spark, sf_dir)
    hours = materialise(profiles.forecast_rows(readings), "hours").until_exit()
    sensors = materialise(profiles.sensor_profile(readings), "sensors").until_exit()
    jobs = [
        (profiles.fit_forecast(hours, FORECAST_BOUNDARY), profiles.apply_forecast, hours, "forecast"),
        (profiles.fit_clusters(sensors), profiles.apply_clusters, sensors, "cluster"),
        (profiles.fit_classifier(readings), profiles.apply_classifier, readings.select("row_id", *FEATURES), "is_flagged"),
    ]
    shelf = Shelf(_folder(spark, "shelf"))
    for learned, *_ in jobs:
        shelf.save(spark, learned, AS_OF)
    compared = []
    for learned, apply, rows, output in jobs:
        before, after = apply(rows, learned), apply(rows, shelf.load(spark, learned.kind))
        counts = after.agg(F.count(F.lit(1)).alias("n_rows"), F.count(output).alias("n_outputs"))
        differs = before.exceptAll(after).agg(F.count(F.lit(1)).alias("n_different"))
        compared.append(counts.withColumns({"n_different": differs.scalar(), "kind": F.lit(learned.kind)}))
    shelved = shelf.entries(spark).select("kind", "version")
    return shelved.join(reduce(DataFrame.unionByName, compared), "kind")
