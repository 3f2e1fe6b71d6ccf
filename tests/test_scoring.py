"""Live scoring: promotions take effect without a restart, replays keep their model."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from samples import messages
from telemetra.__main__ import main
from telemetra.functions.times import instant
from telemetra.operators import registry
from telemetra.operators.evaluate import health_score
from telemetra.operators.forest import ForestSpec, fit, predict, with_prediction
from telemetra.queries import fixture
from telemetra.schemas import FEATURES
from telemetra.sources.messages import read_message_stream
from telemetra.streaming import scoring
from telemetra.streaming.scoring import NoModel, Serving, run_scoring, score_messages
from telemetra.tables import Store
from telemetra.versions import children


@pytest.fixture(scope="module")
def two_models(spark, sf_small):
    """Two forests that differ in their seed and number of trees."""
    rows = fixture.readings(spark, sf_small).select("row_id", *FEATURES)
    fitted = [fit(rows, name, ForestSpec(n_trees=n, seed=n)) for name, n in (("A", 10), ("B", 20))]
    metrics = []
    for one in fitted:
        measured = health_score(with_prediction(one.scores, one.forest.threshold))
        metrics.append(spark.createDataFrame(measured.collect(), measured.schema))
        one.stage.discard()
    return [(one.forest, m) for one, m in zip(fitted, metrics)]


@pytest.fixture
def store(spark, tmp_path, two_models):
    store = Store(str(tmp_path / "store"))
    store.create(spark)
    for forest, metrics in two_models:
        registry.save_model(store, forest, metrics, instant("2024-01-15 00:00:00"))
    return store


def promote(spark, store, model_id, day):
    registry.promote(store, model_id, instant(f"2024-02-{day:02} 00:00:00"), spark)


def part(spark, sf_small, k):
    rows = fixture.messages(spark, sf_small)
    return rows.filter(F.col("row_id") % 3 == k).select("key", "value").coalesce(1)


def models_of(spark, store):
    return {r.batch_id: r.model_id for r in store.scores.read(spark).select("batch_id", "model_id").distinct().collect()}


def test_a_promotion_is_picked_up_by_the_running_stream(spark, sf_small, store, tmp_path, two_models):
    path = str(tmp_path / "landing")
    part(spark, sf_small, 0).write.parquet(path)
    promote(spark, store, "A", 1)
    query = run_scoring(read_message_stream(spark, "parquet", path), store, str(tmp_path / "checkpoint"), {"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
        assert models_of(spark, store) == {0: "A"}
        promote(spark, store, "B", 2)
        part(spark, sf_small, 1).write.mode("append").parquet(path)
        query.processAllAvailable()
        part(spark, sf_small, 2).write.mode("append").parquet(path)
        query.processAllAvailable()
    finally:
        query.stop()
    assert models_of(spark, store) == {0: "A", 1: "B", 2: "B"}
    # The stored scores are those of the batch's model, row by row.
    for batch, (forest, _) in ((0, two_models[0]), (1, two_models[1])):
        wanted = score_messages(part(spark, sf_small, batch), forest).select("row_id", "score", "prediction", "model_id")
        found = store.scores.read(spark).filter(F.col("batch_id") == batch).select(wanted.columns)
        assert found.count() > 200 and found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_a_replayed_batch_keeps_its_model(spark, sf_small, store, tmp_path, monkeypatch):
    path, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    part(spark, sf_small, 0).write.parquet(path)
    promote(spark, store, "A", 1)
    written = []

    def lost_after_writing(table, shape, write=scoring.table_sink):
        def sink(batch, batch_id):
            write(table, shape)(batch, batch_id)
            written.append(batch_id)
            raise RuntimeError("lost")

        return sink

    monkeypatch.setattr(scoring, "table_sink", lost_after_writing)
    with pytest.raises(Exception, match="lost"):
        run_scoring(read_message_stream(spark, "parquet", path), store, checkpoint).awaitTermination()
    monkeypatch.undo()
    n = store.scores.read(spark).count()
    promote(spark, store, "B", 2)
    run_scoring(read_message_stream(spark, "parquet", path), store, checkpoint).awaitTermination()
    assert written == [0] and models_of(spark, store) == {0: "A"} and store.scores.read(spark).count() == n
    part(spark, sf_small, 1).write.mode("append").parquet(path)
    run_scoring(read_message_stream(spark, "parquet", path), store, checkpoint).awaitTermination()
    assert models_of(spark, store) == {0: "A", 1: "B"}


def test_without_a_promoted_model_nothing_is_scored(spark, sf_small, store, tmp_path):
    path = str(tmp_path / "landing")
    part(spark, sf_small, 0).write.parquet(path)
    with pytest.raises(Exception, match=NoModel.__doc__[:-1].lower()):
        run_scoring(read_message_stream(spark, "parquet", path), store, str(tmp_path / "checkpoint")).awaitTermination()
    assert store.scores.read(spark).count() == 0


def test_records_are_few(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr(scoring, "RECORDED_BATCHES", 3)
    serving = Serving(store, str(tmp_path / "records"))
    promote(spark, store, "A", 1)
    for batch in range(6):
        assert serving.model_of(spark, batch) == "A"
    assert [int(name) for name in children(spark, serving.records)] == [3, 4, 5]
    # Loaded once, as long as the model stays.
    first = serving.forest_of(spark, 5)
    assert serving.forest_of(spark, 5) is first
    promote(spark, store, "B", 2)
    assert serving.forest_of(spark, 6).model_id == "B" and serving.forest_of(spark, 5).model_id == "A"


def test_scoring_from_the_command_line(spark, sf_small, store, tmp_path):
    path, root, to = str(tmp_path / "landing"), str(tmp_path / "store"), str(tmp_path / "scored")
    part(spark, sf_small, 0).write.parquet(path)
    arguments = ["score", "--root", root, "--path", path, "--checkpoint", str(tmp_path / "checkpoint"), "--to", to]
    with pytest.raises(SystemExit, match="promoted"):
        main(arguments)
    promote(spark, store, "A", 1)
    main(arguments)
    found = spark.read.parquet(to)
    assert found.count() > 200 and {r.model_id for r in found.select("model_id").distinct().collect()} == {"A"}


def test_batch_and_loaded_model_agree(spark, store, two_models):
    forest = registry.load_forest(store, spark, "A")
    rows = messages(spark, []).select("key", "value")
    assert predict(scoring.arriving_readings(rows), forest).count() == 0
    assert forest.threshold == two_models[0][0].threshold
