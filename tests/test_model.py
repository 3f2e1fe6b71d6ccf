from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import flat
from telemetra.functions.times import instant
from telemetra.operators import evaluate, forest, registry, training
from telemetra.operators.evaluate import health_score
from telemetra.operators.quantile import exact_quantile
from telemetra.plans.backfill import backfill, model_keys
from telemetra.queries import fixture
from telemetra.schemas import FEATURES, FOREST_NODES
from telemetra.sources.messages import read_message_stream
from telemetra.streaming.scoring import score_messages
from telemetra.tables import Store

AS_OF = "2024-01-15 00:00:00"
NAN = float("nan")
SPEC = forest.ForestSpec(n_trees=30)


# --- training set


def test_small_window_is_an_error(spark, sf_small):
    from telemetra.functions.times import rolling_window

    window = rolling_window(fixture.readings(spark, sf_small), AS_OF).select("row_id", *FEATURES)
    with pytest.raises(training.NotEnoughRows, match="20 valid rows"):
        training.checked_count(window)
    assert training.checked_count(window, min_rows=20) == 20


def test_empty_range_is_an_error(spark, sf_small):
    extracted = training.extract_range(fixture.readings(spark, sf_small), "2030-01-01", "2030-01-02")
    with pytest.raises(training.EmptyRange):
        training.checked_count(extracted)


def test_extraction_counts(spark, sf_medium):
    readings = fixture.readings(spark, sf_medium)
    assert training.extract_recent(readings, AS_OF).count() == 5_028
    assert training.checked_count(readings.select("row_id", *FEATURES)) == 8_587


def test_extraction_in_sql_is_the_same(spark, sf_medium):
    readings, bounds = fixture.readings(spark, sf_medium), ("2024-01-08 00:00:00", "2024-01-14 23:59:59")
    one = training.extract_range(readings, *bounds)
    other = training.extract_range_sql(spark, readings, *bounds)
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_validation_drops_null_nan_and_humidity(spark):
    df = flat(spark, [{}, {"o3": None}, {"no2": NAN}, {"humidity": 101}, {"humidity": 0}, {"humidity": 100}])
    assert [row["row_id"] for row in training.validate(df).orderBy("row_id").collect()] == [0, 4, 5]
    assert tuple(training.row_counts(df).first()) == (6, 3, 3)
    dropped = df.na.drop(subset=list(FEATURES)).filter("humidity BETWEEN 0 AND 100")
    assert dropped.exceptAll(training.validate(df)).isEmpty()


# --- exact quantile


def quantiles(spark, groups, q, **options):
    rows = [(name, float(value)) for name, values in groups.items() for value in values]
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE").repartition(5)
    return exact_quantile(df, "v", q, "g", {name: len(values) for name, values in groups.items()}, **options)


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 0.999, 1.0])
def test_narrowing_finds_the_quantile(spark, q):
    rng = np.random.default_rng(1)
    groups = {
        "even": rng.uniform(0, 1, 3000),
        "peak": 0.5 + rng.normal(0, 1e-9, 2000),
        "wide": rng.normal(0, 1e6, 1000),
        "copies": np.concatenate([np.full(2000, 0.25), rng.uniform(0, 1, 500)]),
        "constant": np.full(700, 0.125),
        "pair": np.array([0.25] * 500 + [0.75] * 500),
    }
    found = quantiles(spark, groups, q, builtin_rows=0, fetch_rows=10)
    for name, values in groups.items():
        assert found[name] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-15), name


def test_builtin_and_narrowing_agree(spark):
    rng = np.random.default_rng(2)
    groups = {"a": rng.uniform(0, 1, 400), "b": rng.beta(2, 5, 1500)}
    assert quantiles(spark, groups, 0.95) == quantiles(spark, groups, 0.95, builtin_rows=0, fetch_rows=3)
    assert quantiles(spark, groups, 0.95, builtin_rows=1000) == quantiles(spark, groups, 0.95)


# --- isolation forest


def planted(spark, n=2000, outliers=20):
    rng = np.random.default_rng(7)
    normal = rng.normal([20, 30, 25, 50, 20, 60], [2, 3, 5, 10, 1.5, 8], (n, 6))
    odd = rng.normal([90, 90, 150, 150, -30, 5], 1.0, (outliers, 6))
    rows = [(place, *map(float, row[:5]), int(row[5])) for place, row in enumerate(np.vstack([normal, odd]))]
    kinds = "row_id BIGINT, " + ", ".join(f"{name} {'INT' if name == 'humidity' else 'DOUBLE'}" for name in FEATURES)
    return spark.createDataFrame(rows, kinds), n + outliers


@pytest.fixture(scope="module")
def fitted(spark):
    df, n = planted(spark)
    return df, n, forest.fit(df, "m", SPEC)


def test_path_length_constants():
    assert [forest.mean_path_length(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert forest.mean_path_length(256) == pytest.approx(10.2448, abs=1e-3)
    assert [forest.max_depth(n) for n in (1, 2, 3, 256)] == [1, 1, 2, 8]


def test_scores_and_rate(fitted):
    df, n, fit = fitted
    scored = forest.with_prediction(fit.scores, fit.forest.threshold)
    rows = scored.collect()
    assert len(rows) == n and all(0 < row["score"] <= 1 for row in rows)
    rate = sum(row["prediction"] == -1 for row in rows) / n
    assert abs(rate - SPEC.contamination) < 0.005
    top = sorted(rows, key=lambda row: -row["score"])[:20]
    assert {row["row_id"] for row in top} == set(range(2000, 2020))


def test_threshold_is_the_quantile_of_the_scores(fitted):
    _, _, fit = fitted
    scores = [row["score"] for row in fit.scores.collect()]
    assert fit.forest.threshold == pytest.approx(np.quantile(scores, 0.95), rel=1e-12)


def test_tree_shape(fitted):
    _, _, fit = fitted
    nodes = fit.forest.nodes
    assert list(nodes.columns) == FOREST_NODES.names
    for _, tree in nodes.groupby("tree_id"):
        leaves, inner = tree[tree["feature"] < 0], tree[tree["feature"] >= 0]
        assert leaves["size"].sum() == 256 and tree["depth"].max() <= 8
        assert set(inner["left"]) | set(inner["right"]) | {0} == set(tree["node_id"])


def brute_force_score(model, row):
    """Walk every tree node by node."""
    total = 0.0
    for _, tree in model.nodes.groupby("tree_id"):
        by_id = tree.set_index("node_id")
        node = by_id.loc[0]
        while node["feature"] >= 0:
            goes_left = row[FEATURES[int(node["feature"])]] <= node["threshold"]
            node = by_id.loc[int(node["left"] if goes_left else node["right"])]
        total += node["path_length"]
    mean = total / model.spec.n_trees
    return 2 ** (-mean / forest.mean_path_length(model.sample_size))


def test_scores_equal_a_walk_through_the_trees(fitted):
    df, _, fit = fitted
    some = df.filter("row_id % 200 = 0 OR row_id >= 2015")
    for row in forest.score(some, fit.forest).collect():
        assert row["score"] == pytest.approx(brute_force_score(fit.forest, row), rel=1e-12)


def test_same_model_for_any_partitioning(spark, fitted):
    df, n, fit = fitted
    again = forest.fit(df.repartition(9), "m", SPEC)
    assert again.forest.threshold == fit.forest.threshold
    order = ["tree_id", "node_id"]
    left = fit.forest.nodes.sort_values(order).reset_index(drop=True)
    assert left.equals(again.forest.nodes.sort_values(order).reset_index(drop=True))


def test_sample_is_exact_and_drawn_from_a_bounded_pool(spark):
    """A set far larger than the pool: every tree still gets exactly its rows."""
    n = 200_000
    spec = forest.ForestSpec(n_trees=4, max_samples=64)
    df = spark.range(n).select(F.col("id").alias("row_id"), *[F.rand(3).alias(name) for name in FEATURES])
    drawn = forest.candidates(df, "m", forest.Survey(n, n), spec)
    pool = drawn.select("row_id").distinct().count()
    assert pool <= 2 * forest.POOL_FACTOR * 4 * 64
    sizes = forest.samples(drawn, spec).groupBy("tree_id").count().collect()
    assert [row["count"] for row in sizes] == [64] * 4


def shuffled(df):
    """Rows that each exchange of an executed plan has written."""
    df.collect()

    def walk(node):
        metrics = node.metrics()
        if node.nodeName().startswith("Exchange"):
            yield metrics.get("shuffleRecordsWritten").get().value()
        if "QueryStage" in node.nodeName():
            yield from walk(node.plan())
        elif node.nodeName().startswith("AdaptiveSparkPlan"):
            yield from walk(node.executedPlan())
        for i in range(node.children().size()):
            yield from walk(node.children().apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def test_of_a_large_set_only_a_bounded_part_is_shuffled(spark, tmp_path):
    """Beside one number for each bucket, a fixed multiple of the pool, not the training set."""
    n, spec = 400_000, forest.ForestSpec(n_trees=4, max_samples=64)
    pool = forest.POOL_FACTOR * 4 * 64
    made = spark.range(n).select(F.col("id").alias("row_id"), *[F.rand(3).alias(name) for name in FEATURES])
    made.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    rows = shuffled(forest.samples(forest.candidates(df, "m", forest.Survey(n, n), spec), spec))
    assert len(rows) >= 3 and max(rows) < 1.2 * forest.OVER * pool < n / 4
    assert sorted(rows)[-2] < 4 * pool
    assert forest.samples(forest.candidates(df, "m", forest.Survey(n, n), spec), spec).count() == 4 * 64


def test_small_groups_of_copies_in_a_large_set(spark):
    """Groups too small to be found apart are drawn whole or in parts; together they have their share."""
    n, spec = 400_000, forest.ForestSpec(n_trees=4, max_samples=64)
    copies = spark.range(1_000).crossJoin(spark.range(200).select(F.lit(1).alias("one")))
    same = copies.select((-F.col("id") - 1).alias("row_id"), *[(F.col("id") / 1000.0).alias(name) for name in FEATURES])
    other = spark.range(n // 2).select(F.col("id").alias("row_id"), *[F.rand(3).alias(name) for name in FEATURES])
    df = same.unionByName(other)
    pool = forest._pool(forest.tagged({"m": df}, spec), {"m": forest.Survey(n, n)}, spec)
    rows = pool.groupBy((F.col("row_id") < 0).alias("copied")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("row_id").alias("groups")).collect()
    found = {r.copied: r for r in rows}
    wanted = forest.POOL_FACTOR * 4 * 64
    assert 0.75 * wanted < found[True].n + found[False].n < 1.25 * wanted
    assert 0.35 < found[True].n / wanted < 0.65 and found[True].groups > 100


def test_ranges_are_read_in_one_scan(spark, sf_small):
    readings = fixture.readings(spark, sf_small)
    days = [f"2024-01-{day:02}" for day in range(1, 17)]
    ranges = {f"r{i}": (f"{day} 00:00:00", f"2024-01-{i + 12:02} 12:00:00") for i, day in enumerate(days)}
    found = training.extract_ranges(readings, ranges)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "GreaterThanOrEqual(ts,2024-01-01" in plan
    columns = ["row_id", *FEATURES]
    for key, bounds in ranges.items():
        one, other = found.filter(F.col("model_id") == key).select(columns), training.extract_range(readings, *bounds)
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    assert found.groupBy("row_id").count().agg(F.max("count")).first()[0] >= 12


def test_a_row_in_three_ranges_counts_three_times(spark):
    rows = flat(spark, [{"pm2_5": float(n % 23)} for n in range(90)])
    ranges = {key: ("2024-01-14 00:00:00", f"2024-01-{day} 00:00:00") for key, day in (("a", 15), ("b", 16), ("c", 17))}
    known = forest.survey_tagged(training.extract_ranges(rows, ranges), list(ranges), SPEC)
    assert {one.n_valid for one in known.values()} == {90}
    fitted = forest.fit_tagged(training.extract_ranges(rows, ranges), list(ranges), SPEC)
    nodes = [one.forest.nodes.drop(columns="model_id").sort_values(["tree_id", "node_id"]).reset_index(drop=True) for one in fitted.values()]
    assert nodes[0].equals(nodes[1]) and nodes[0].equals(nodes[2])
    assert len({one.forest.threshold for one in fitted.values()}) == 1
    fitted["a"].stage.discard()


def with_copies(spark, n):
    """Two thirds different rows; one third copies of a single row, with the same row_id."""
    different = spark.range(2 * n // 3).select(
        F.col("id").alias("row_id"),
        *[(F.pmod(F.xxhash64("id", F.lit(name)), F.lit(1000)) / 1000.0).alias(name) for name in FEATURES],
    )
    copies = spark.range(n // 3).select(F.lit(-1).cast("bigint").alias("row_id"), *[F.lit(0.5).alias(x) for x in FEATURES])
    return different.unionByName(copies)


@pytest.mark.parametrize("n", [1_500, 60_000, 399_999])
def test_copies_are_sampled_by_their_share(spark, n):
    spec = forest.ForestSpec(n_trees=10, max_samples=64)
    df = with_copies(spark, n)
    known = forest.survey({"m": df}, spec)["m"]
    assert (known.n_extracted, known.n_valid) == (n, n)

    def sampled(rows):
        drawn = forest.samples(forest.candidates(rows, "m", known, spec), spec)
        return sorted(tuple(row) for row in drawn.select("tree_id", "row_id", "copy", "draw").collect())

    rows = sampled(df)
    assert len(rows) == 640 and len(set(rows)) == 640
    assert 0.27 < sum(row[1] == -1 for row in rows) / 640 < 0.40
    assert rows == sampled(df.repartition(7))


def test_many_groups_of_copies_reach_every_tree(spark):
    """As many copies of each row as make every group larger than a tree, and none frequent by itself."""
    spec = forest.ForestSpec(n_trees=10, max_samples=32)
    copies = with_copies(spark, 300).filter("row_id >= 0").crossJoin(spark.range(100).select(F.lit(1).alias("one"))).drop("one")
    fitted = forest.fit(copies, "m", spec)
    nodes = fitted.forest.nodes
    assert sorted(nodes[nodes["node_id"] == 0]["size"]) == [32] * 10
    known = forest.survey({"m": copies}, spec)["m"]
    drawn = forest.samples(forest.candidates(copies, "m", known, spec), spec)
    assert drawn.select("row_id").distinct().count() > 100


def test_missing_trees_are_an_error(spark):
    rows = flat(spark, [{"pm2_5": float(n)} for n in range(80)]).select("row_id", *FEATURES)
    whole = forest.fit(rows, "m", SPEC).forest
    with pytest.raises(forest.IncompleteForest):
        forest.assert_whole(replace(whole, nodes=whole.nodes[whole.nodes["tree_id"] > 0]))


def test_infinite_features_are_incomplete(spark):
    rows = flat(spark, [{"pm2_5": float(n)} for n in range(80)] + [{"no2": float("inf")}, {"o3": float("-inf")}])
    assert tuple(training.row_counts(rows).first()) == (82, 80, 2)
    fitted = forest.fit(rows.select("row_id", *FEATURES), "m", replace(SPEC, max_samples=80))
    assert fitted.n_rows == 80


def test_forest_on_other_features_is_the_same_after_reload(spark, tmp_path):
    spec = replace(SPEC, features=("temperature", "o3", "pm2_5"))
    rows = flat(spark, [{"pm2_5": float(n % 17), "o3": float(n % 29), "temperature": float(n % 13)} for n in range(200)])
    fitted = forest.fit(rows.select("row_id", *spec.features), "other", spec)
    store = Store(str(tmp_path))
    store.create(spark)
    metrics = health_score(forest.with_prediction(fitted.scores, fitted.forest.threshold), spec.contamination)
    registry.save_model(store, fitted.forest, metrics, F.current_timestamp())
    again = registry.load_forest(store, spark, "other")
    assert again.spec == spec
    before, after = (forest.score(rows, one).select("row_id", "score") for one in (fitted.forest, again))
    assert before.exceptAll(after).isEmpty()
    with pytest.raises(registry.UnknownModel):
        registry.load_forest(store, spark, "none")


def test_survey_counts_like_validation(spark, sf_medium):
    extracted = fixture.readings(spark, sf_medium).select("row_id", *FEATURES)
    known = forest.survey({"m": extracted, "none": extracted.limit(0)}, SPEC)
    counts = training.row_counts(extracted).first()
    assert (known["m"].n_extracted, known["m"].n_valid) == (counts["n_extracted"], counts["n_valid"])
    assert known["none"] == forest.Survey(0, 0)


def test_fit_needs_enough_rows(spark):
    rows = flat(spark, [{}] * 49 + [{"o3": None}] * 10).select("row_id", *FEATURES)
    with pytest.raises(training.NotEnoughRows, match="49 valid rows"):
        forest.fit(rows, "m", SPEC)
    with pytest.raises(training.EmptyRange):
        forest.fit(rows.limit(0), "m", SPEC)


def test_few_rows_and_copies(spark):
    df = flat(spark, [{}] * 60 + [{"pm2_5": 99.0}])
    fit = forest.fit(df.select("row_id", *FEATURES), "tiny", SPEC)
    rows = forest.predict(df, fit.forest).collect()
    assert fit.forest.sample_size == 61
    assert [row["row_id"] for row in rows if row["prediction"] == -1] == [60]


def test_missing_features_have_no_score(spark, fitted):
    _, _, fit = fitted
    df = flat(spark, [{"o3": None}, {"no2": NAN}, {}])
    rows = forest.predict(df, fit.forest).orderBy("row_id").collect()
    assert [row["score"] is None for row in rows] == [True, True, False]
    assert [row["prediction"] is None for row in rows] == [True, True, False]


def test_stored_forest_scores_the_same(spark, fitted, tmp_path):
    df, _, fit = fitted
    store = Store(str(tmp_path))
    store.create(spark)
    metrics = evaluate.health_score(forest.with_prediction(fit.scores, fit.forest.threshold))
    registry.save_model(store, fit.forest, metrics, instant(AS_OF))
    loaded = registry.load_forest(store, spark, "m")
    left, right = forest.predict(df, fit.forest), forest.predict(df, loaded)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    assert store.models.read(spark).first()["health_score"] == pytest.approx(1.0, abs=0.005)


def test_stream_scores_equal_batch_scores(spark, sf_small, tmp_path):
    readings = fixture.readings(spark, sf_small)
    extracted = readings.select("row_id", *FEATURES)
    fit = forest.fit(extracted, "m", SPEC)
    path = str(tmp_path / "landing")
    fixture.messages(spark, sf_small).drop("row_id").repartition(3).write.parquet(path)
    scored = score_messages(read_message_stream(spark, "parquet", path), fit.forest)
    query = scored.writeStream.format("memory").queryName("scored").trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "c")).start().awaitTermination()
    columns = ("sensor_id", "event_time", "score", "prediction")
    live, batch = spark.table("scored").select(*columns), forest.predict(readings, fit.forest).select(*columns)
    assert live.exceptAll(batch).isEmpty() and batch.exceptAll(live).isEmpty()


# --- backfill


def test_backfill_fits_one_model_per_range(spark, sf_medium):
    ranges = [("2024-01-01 00:00:00", "2024-01-10 23:59:59"), ("2024-01-05 00:00:00", "2024-01-31 23:59:59")]
    readings = fixture.readings(spark, sf_medium)
    result = backfill(readings, ranges, spec=forest.ForestSpec(n_trees=10, contamination=0.1))
    assert list(result.fitted) == model_keys(spark, ranges)
    assert list(result.fitted)[0] == "isolation_forest_2024-01-01T00-00-00_to_2024-01-10T23-59-59"
    for row in result.metrics.collect():
        assert row["anomaly_rate"] == pytest.approx(0.1, abs=0.01)
    alone = backfill(readings, ranges[:1], spec=forest.ForestSpec(n_trees=10, contamination=0.1))
    key = list(result.fitted)[0]
    assert alone.fitted[key].forest.threshold == result.fitted[key].forest.threshold


def test_backfill_errors(spark, sf_small):
    readings = fixture.readings(spark, sf_small)
    with pytest.raises(training.EmptyRange):
        backfill(readings, [("2030-01-01 00:00:00", "2030-01-02 00:00:00")])
    with pytest.raises(training.NotEnoughRows):
        backfill(readings, [("2024-01-01 00:00:00", "2024-01-02 00:00:00")], min_rows=500)
    with pytest.raises(ValueError, match="contamination"):
        backfill(readings, [("2024-01-01", "2024-01-02")], spec=forest.ForestSpec(contamination=0.6))


def test_backfill_rejects_a_pathological_model(spark):
    """Rows that are all alike share one score, so none is above the threshold."""
    readings = flat(spark, [{}] * 80)
    with pytest.raises(evaluate.PathologicalModel):
        backfill(readings, [("2024-01-14 00:00:00", "2024-01-15 00:00:00")], spec=SPEC)


# --- evaluation and registry


def predictions(spark, n_anomalies, n):
    return spark.range(n).select(evaluate.as_prediction(F.col("id") < n_anomalies).alias("prediction"))


@pytest.mark.parametrize("n_anomalies, health", [(5, 1.0), (0, 0.95), (100, 0.05), (10, 0.95)])
def test_health_score(spark, n_anomalies, health):
    row = evaluate.health_score(predictions(spark, n_anomalies, 100)).first()
    assert row["health_score"] == pytest.approx(health)


def test_pathological_models(spark):
    for n_anomalies, bad in [(0, True), (1, False), (99, False), (100, True)]:
        metrics = evaluate.health_score(predictions(spark, n_anomalies, 100))
        assert evaluate.with_pathology(metrics).first()["pathological"] is bad
        if bad:
            with pytest.raises(evaluate.PathologicalModel):
                evaluate.assert_healthy(metrics)
        else:
            evaluate.assert_healthy(metrics)


def test_label_eval(spark, sf_medium):
    readings = fixture.readings(spark, sf_medium)
    from telemetra.functions.air import is_anomaly, is_labelled

    flag = F.coalesce(is_anomaly(F.col), F.lit(False))
    row = evaluate.label_eval(readings, flag, is_labelled(F.col("is_true_anomaly"))).first()
    assert (row["tp"], row["tp"] + row["fn"], row["tp"] + row["fp"]) == (97, 447, 1828)
    assert row["precision"] == pytest.approx(97 / 1828) and row["recall"] == pytest.approx(97 / 447)
    empty = evaluate.label_eval(readings.limit(0), flag, is_labelled(F.col("is_true_anomaly"))).first()
    assert empty["precision"] is None


def models(spark, scores):
    rows = [(f"m{day}", datetime(2024, 1, day + 1), 100, 0.05, float(score)) for day, score in enumerate(scores)]
    return spark.createDataFrame(
        rows, "model_id STRING, created_at TIMESTAMP, n_rows BIGINT, anomaly_rate DOUBLE, health_score DOUBLE"
    )


@pytest.mark.parametrize("score, decision", [(0.90, "keep"), (0.9000001, "promote"), (0.5, "keep"), (1.0, "promote")])
def test_first_model_has_to_beat_the_fallback(spark, score, decision):
    none = spark.createDataFrame([], "model_id STRING, promoted_at TIMESTAMP")
    candidate = models(spark, [score])
    row = registry.promotion_decision(candidate, models(spark, []), none).first()
    assert (row["champion_score"], row["decision"]) == (0.90, decision)


def test_champion_is_the_latest_promotion(spark):
    known = models(spark, [0.95, 0.99, 0.97])
    promotions = spark.createDataFrame(
        [("m1", datetime(2024, 1, 5)), ("m0", datetime(2024, 1, 6))], "model_id STRING, promoted_at TIMESTAMP"
    )
    assert registry.current_model(known, promotions).first()["model_id"] == "m0"
    row = registry.promotion_decision(models(spark, [0.96]), known, promotions).first()
    assert (row["champion_score"], row["decision"]) == (0.95, "promote")
    assert registry.current_model(known, promotions.limit(0)).isEmpty()


def test_history_follows_the_running_champion(spark):
    rows = registry.promotion_history(models(spark, [0.85, 0.92, 0.91, 0.92, 0.95])).orderBy("created_at").collect()
    assert [row["decision"] for row in rows] == ["keep", "promote", "keep", "keep", "promote"]
    assert [row["champion_score"] for row in rows] == [0.9, 0.9, 0.92, 0.92, 0.92]
    versions = registry.versions(models(spark, [0.5, 0.6])).orderBy("version").collect()
    assert [row["model_id"] for row in versions] == ["m0", "m1"]
