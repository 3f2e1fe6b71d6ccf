"""Isolation forest (Liu, Ting and Zhou, 2008) as Spark jobs.

Sampling is a filter and a window, trees grow in parallel on groups of at most ``max_samples``
rows, and scoring is a vectorised function over the columns of any DataFrame, batch or streaming.
A fitted forest has a fixed maximum size (trees x 2 x samples nodes) that does not depend on the
data, so it travels with the scoring function. Several training sets, which may overlap, are fitted
together: a row carries the id of the model it is for, and every pass reads the readings once.

Which rows a tree gets and where its nodes split follows from hashes that any SQL engine has, so the
same forest can be grown level by level in SQL.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil, log, log2

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetra import rules
from telemetra.operators.quantile import exact_quantile
from telemetra.operators.training import assert_enough, row_counts, validate
from telemetra.schemas import FEATURES, FOREST_NODES
from telemetra.sources.scans import Staged, materialise

EULER = 0.5772156649015329
# The pool from which trees draw holds this many times the rows that all trees together need,
# and each tree first takes this many times the rows it keeps.
POOL_FACTOR = 4
# Of large sets this many times the pool is looked at, by hash of the row. Rows that many copies share are found apart: from this
# share of the pool on, by counting rows in so many buckets.
OVER, HEAVY_SHARE, BUCKETS = 64, 0.01, 65_536
HASH_RANGE = 2**64
# Draws are whole numbers below this prime.
PRIME = 2**31 - 1
# Feature and children of a node that is not split.
LEAF = -1

# The functions below travel to the executors whole, so that these need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class ForestSpec:
    n_trees: int = rules.N_TREES
    max_samples: int = rules.MAX_SAMPLES
    contamination: float = rules.CONTAMINATION
    seed: int = rules.SEED
    features: tuple[str, ...] = FEATURES


@dataclass(frozen=True)
class Forest:
    """A fitted forest: its node rows and the score above which a row is an anomaly."""

    model_id: str
    spec: ForestSpec
    sample_size: int
    nodes: pd.DataFrame
    threshold: float | None = None


@dataclass(frozen=True)
class Fitted:
    """A forest with the stored scores (row_id, score) of the rows it was trained on.

    Forests fitted together share one stored table.
    """

    forest: Forest
    n_rows: int
    scores: DataFrame
    stage: Staged


def mean_path_length(n: int) -> float:
    """Average path length of an unsuccessful search among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def max_depth(sample_size: int) -> int:
    return ceil(log2(max(sample_size, 2)))


def _chance(*columns: str | F.Column) -> F.Column:
    """A number in [0, 1) for each row, the same however rows are partitioned."""
    return F.xxhash64(*columns) / float(HASH_RANGE) + 0.5


def _row_key(spec: ForestSpec) -> F.Column:
    """Hash of a row; only exact copies share it."""
    return F.xxhash64("row_id", *spec.features)


@dataclass(frozen=True)
class Survey:
    """What fitting has to know about a training set beforehand."""

    n_extracted: int
    n_valid: int


def tagged(extracted: dict[str, DataFrame], spec: ForestSpec) -> DataFrame:
    """Rows (model_id, row_id, features) of several training sets."""
    named = [rows.select(F.lit(key).alias("model_id"), "row_id", *spec.features) for key, rows in extracted.items()]
    return reduce(DataFrame.unionByName, named)


def survey_tagged(rows: DataFrame, keys: Sequence[str], spec: ForestSpec) -> dict[str, Survey]:
    """Rows extracted and valid per training set, all sets counted in one pass."""
    counted = row_counts(rows, ("model_id",), spec.features).collect()
    known = {row["model_id"]: Survey(row["n_extracted"], row["n_valid"]) for row in counted}
    return {key: known.get(key, Survey(0, 0)) for key in keys}


def survey(extracted: dict[str, DataFrame], spec: ForestSpec) -> dict[str, Survey]:
    return survey_tagged(tagged(extracted, spec), list(extracted), spec)


def _by_model(values: dict[str, float]) -> F.Column:
    """A number of each row's model."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col("model_id"))


def _frequent(rows: DataFrame, known: dict[str, Survey], least: float, spec: ForestSpec) -> DataFrame:
    """Rows of which there are at least ``least`` copies, with their number.

    Rows are counted by bucket of their hash, at most ``BUCKETS`` numbers for each task and model. Only rows of buckets that stand
    out are counted one by one, on the map side first, where copies become one row.
    """
    in_bucket = rows.withColumn("bucket", F.pmod(_row_key(spec), F.lit(BUCKETS)))
    mean = _by_model({key: one.n_valid / BUCKETS for key, one in known.items()})
    sizes = in_bucket.groupBy("model_id", "bucket").agg(F.count(F.lit(1)).alias("size"))
    full = sizes.filter(F.col("size") >= F.greatest(F.lit(float(least)), mean + least / 2)).select("model_id", "bucket")
    stand_out = materialise(full, "forest-buckets").until_exit()
    copies = in_bucket.join(stand_out, ["model_id", "bucket"], "left_semi")
    return copies.groupBy("model_id", "row_id", *spec.features).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def _pool(rows: DataFrame, known: dict[str, Survey], spec: ForestSpec) -> DataFrame:
    """About as many rows of each model as the pool holds, numbered among their copies.

    Rows with the same key and features share a hash and would be taken all together or not at all, so a group of n copies
    gives its part by count. Of a large set only rows of the lowest hashes are grouped, a fixed number whatever the set's size, and
    each group stands for those that were passed over. Groups large enough to matter by themselves are all counted.
    """
    pool_rows = POOL_FACTOR * spec.n_trees * spec.max_samples
    share = {key: min(1.0, pool_rows / max(1, one.n_valid)) for key, one in known.items()}
    looked_at = {key: min(1.0, OVER * part) for key, part in share.items()}
    columns = ["model_id", "row_id", *spec.features, "n"]
    if all(part == 1.0 for part in looked_at.values()):
        grouped = rows.groupBy(*columns[:-1]).agg(F.count(F.lit(1)).alias("n")).withColumn("expected", F.col("n") * _by_model(share))
    else:
        least = OVER * pool_rows * HEAVY_SHARE
        low = rows.filter(_chance(_row_key(spec), F.lit(spec.seed + 2)) < _by_model(looked_at))
        light = low.groupBy(*columns[:-1]).agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") < least) | (_by_model(looked_at) == 1.0))
        large = {key: one for key, one in known.items() if looked_at[key] < 1.0}
        heavy = _frequent(rows.filter(F.col("model_id").isin(list(large))), large, least, spec)
        grouped = light.withColumn("expected", F.col("n") * _by_model({key: share[key] / looked_at[key] for key in share}))
        grouped = grouped.unionByName(heavy.withColumn("expected", F.col("n") * _by_model(share)))
    taken = F.floor(F.col("expected") + _chance(_row_key(spec), F.lit(spec.seed)))
    chosen = grouped.withColumn("taken", taken).filter("taken > 0")
    numbered = chosen.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("taken", "n").cast("int"))))
    return numbered.select("model_id", "row_id", *spec.features, "copy")


def _mark(spec: ForestSpec) -> F.Column:
    """A row's number below ``PRIME``, from the md5 of its key, features (six digits after the point) and copy."""
    numbers = [F.col(name).cast("double").try_cast("decimal(38,6)").cast("string") for name in spec.features]
    text = F.concat_ws("|", F.col("row_id").cast("string"), *numbers, F.col("copy").cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % PRIME


def _hexes(text: str) -> tuple[int, int]:
    """The first two groups of eight digits of an md5."""
    digest = hashlib.md5(text.encode(), usedforsecurity=False).hexdigest()
    return int(digest[:8], 16), int(digest[8:16], 16)


def tree_factors(spec: ForestSpec, tree: int) -> tuple[int, int]:
    """Factor and summand that turn a row's mark into its draw for a tree."""
    factor, summand = _hexes(f"{spec.seed}|{tree}")
    return 1 + factor % (PRIME - 1), summand % PRIME


def candidates_tagged(rows: DataFrame, known: dict[str, Survey], spec: ForestSpec) -> DataFrame:
    """For every tree a few times as many of a model's rows as it will keep, those of the lowest draws.

    Pool rows are few, but a hundred times as many with their trees: they are spread over all cores first.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    pool = _pool(rows, known, spec).withColumn("mark", _mark(spec)).repartition(cores, "mark", "row_id")
    pool_rows = POOL_FACTOR * spec.n_trees * spec.max_samples
    limits = {key: min(float(PRIME), PRIME * POOL_FACTOR * spec.max_samples / max(1, min(one.n_valid, pool_rows))) for key, one in known.items()}
    factors, summands = zip(*[tree_factors(spec, tree) for tree in range(spec.n_trees)])

    def of_tree(numbers: Sequence[int]) -> F.Column:
        return F.element_at(F.array(*[F.lit(n).cast("long") for n in numbers]), F.col("tree_id") + 1)

    per_tree = pool.select(
        "model_id",
        F.explode(F.sequence(F.lit(0), F.lit(spec.n_trees - 1))).alias("tree_id"),
        "row_id",
        "copy",
        "mark",
        *[F.col(name).cast("double").alias(name) for name in spec.features],
    )
    draw = (of_tree(factors) * F.col("mark") + of_tree(summands)) % PRIME
    return per_tree.withColumn("draw", draw).filter(F.col("draw") < _by_model(limits)).drop("mark")


def candidates(training: DataFrame, model_id: str, known: Survey, spec: ForestSpec) -> DataFrame:
    return candidates_tagged(tagged({model_id: training}, spec), {model_id: known}, spec)


def samples(drawn: DataFrame, spec: ForestSpec, n_models: int = 1) -> DataFrame:
    """The rows of every tree: the ``max_samples`` lowest draws.

    The number of partitions is given, since adaptive coalescing would put these few rows, and with
    them the growing of all trees, into one task. Window and growing share this one shuffle.
    """
    cores = drawn.sparkSession.sparkContext.defaultParallelism
    spread = drawn.repartition(max(cores, n_models * min(spec.n_trees, cores)), "model_id", "tree_id")
    lowest = Window.partitionBy("model_id", "tree_id").orderBy("draw", "row_id", "copy", *spec.features)
    return spread.withColumn("place", F.row_number().over(lowest)).filter(F.col("place") <= spec.max_samples)


def _grow_tree(rows: np.ndarray, name: str) -> list[tuple]:
    """Split rows at random until they are alone, alike, or at the depth limit.

    Nodes are numbered as in a heap: the children of node i are 2i+1 and 2i+2. The md5 of a tree's name and a node's number
    chooses among the features that differ, and the place between their lowest and highest value.
    """
    limit = max_depth(len(rows))
    nodes = []
    pending = [(0, 0, rows)]
    while pending:
        node, depth, part = pending.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        splittable = np.flatnonzero(low < high)
        if depth == limit or splittable.size == 0:
            path = depth + mean_path_length(len(part))
            nodes.append((node, LEAF, None, LEAF, LEAF, len(part), depth, path))
            continue
        which, where = _hexes(f"{name}|{node}")
        feature = int(splittable[which * splittable.size >> 32])
        threshold = low[feature] + where / 2.0**32 * (high[feature] - low[feature])
        if threshold >= high[feature]:
            threshold = low[feature]
        left = part[:, feature] <= threshold
        nodes.append((node, feature, threshold, 2 * node + 1, 2 * node + 2, len(part), depth, None))
        pending.append((2 * node + 2, depth + 1, part[~left]))
        pending.append((2 * node + 1, depth + 1, part[left]))
    return nodes


def grow(sampled: DataFrame, spec: ForestSpec) -> DataFrame:
    """Node rows of all trees; every group holds at most ``max_samples`` rows."""
    features, seed = list(spec.features), spec.seed
    columns = ["node_id", "feature", "threshold", "left", "right", "size", "depth", "path_length"]

    def tree(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        model_id, tree_id = key
        grown = _grow_tree(rows[features].to_numpy(dtype="float64"), f"{seed}|{tree_id}")
        nodes = pd.DataFrame(grown, columns=columns)
        return nodes.assign(model_id=model_id, tree_id=tree_id)[FOREST_NODES.names]

    return sampled.groupBy("model_id", "tree_id").applyInPandas(tree, FOREST_NODES)


def _fetch_nodes(nodes: DataFrame, spec: ForestSpec, n_models: int) -> pd.DataFrame:
    """Node rows on the driver. Their number is bounded by the forest's shape, not by the data."""
    bound = n_models * spec.n_trees * 2 ** (max_depth(spec.max_samples) + 1)
    fetched = nodes.limit(bound + 1).toArrow().to_pandas()
    if len(fetched) > bound:
        raise ValueError("more nodes than this forest can have; are model ids unique?")
    return fetched


class IncompleteForest(ValueError):
    """Trees are missing or were grown on too few rows."""


def assert_whole(forest: Forest) -> None:
    """Every tree has a root over as many rows as scoring assumes."""
    roots = forest.nodes[forest.nodes["node_id"] == 0]
    short = int((roots["size"] != forest.sample_size).sum())
    if len(roots) != forest.spec.n_trees or short:
        raise IncompleteForest(f"{len(roots)} of {forest.spec.n_trees} trees, {short} of them on other than {forest.sample_size} rows")


def _heap_arrays(forest: Forest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per tree: split feature and threshold of inner nodes, path length of bottom places.

    A leaf above the bottom sends every row left, down to the bottom place that has its length.
    """
    depth = max_depth(forest.sample_size)
    inner, trees = 2**depth - 1, forest.spec.n_trees
    feature = np.zeros((trees, inner), dtype=np.int64)
    threshold = np.full((trees, inner), np.inf)
    length = np.zeros((trees, inner + 1))
    nodes = forest.nodes
    split = nodes[nodes["feature"] != LEAF]
    feature[split["tree_id"], split["node_id"]] = split["feature"]
    threshold[split["tree_id"], split["node_id"]] = split["threshold"]
    leaf = nodes[nodes["feature"] == LEAF]
    below = 2 ** (depth - leaf["depth"].to_numpy())
    bottom = (leaf["node_id"].to_numpy() + 1) * below - 1
    length[leaf["tree_id"], bottom - inner] = leaf["path_length"]
    return feature, threshold, length


def _scorer(forest: Forest) -> Callable[[np.ndarray], np.ndarray]:
    """A function from features (a row for each, a column for each reading) to scores; NaN where a feature is missing."""
    feature, threshold, length = _heap_arrays(forest)
    trees, inner = feature.shape
    levels = max_depth(forest.sample_size)
    scale = trees * mean_path_length(forest.sample_size)

    def scores(values: np.ndarray) -> np.ndarray:
        n_rows = values.shape[1]
        flat, row = values.ravel(), np.arange(n_rows)
        total = np.zeros(n_rows)
        for tree in range(trees):
            start, limit = feature[tree] * n_rows, threshold[tree]
            node = np.zeros(n_rows, dtype=np.int64)
            for _ in range(levels):
                right = flat.take(start.take(node) + row) > limit.take(node)
                node *= 2
                node += 1
                node += right
            total += length[tree].take(node - inner)
        found = np.exp2(-total / scale) if scale else np.ones(n_rows)
        found[np.isnan(values).any(axis=0)] = np.nan
        return found

    return scores


def _values(columns: Sequence[pd.Series]) -> np.ndarray:
    return np.vstack([column.to_numpy(dtype="float64", na_value=np.nan) for column in columns])


def score_column(forest: Forest) -> F.Column:
    """Anomaly score in (0, 1]; NULL where a feature is missing."""
    scores = _scorer(forest)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(scores(_values(columns)))

    return score(*[F.col(name).cast("double") for name in forest.spec.features])


def score_tagged(rows: DataFrame, forests: dict[str, Forest], spec: ForestSpec) -> DataFrame:
    """Rows (model_id, row_id, score), each by the forest of its model."""
    scorers = {key: _scorer(forest) for key, forest in forests.items()}

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for models, *columns in batches:
            values, found = _values(columns), np.empty(len(models))
            for key, places in models.groupby(models).indices.items():
                found[places] = scorers[key](np.ascontiguousarray(values[:, places]))
            yield pd.Series(found)

    scored = rows.select("model_id", "row_id", score("model_id", *[F.col(name).cast("double") for name in spec.features]).alias("score"))
    return scored.withColumn("score", F.when(~F.isnan("score"), F.col("score")))


def score(df: DataFrame, forest: Forest) -> DataFrame:
    """Add the anomaly score. Only the features travel to Python, other columns stay where they are."""
    scored = df.withColumn("score", score_column(forest))
    return scored.withColumn("score", F.when(~F.isnan("score"), F.col("score")))


def with_prediction(scored: DataFrame, threshold: float) -> DataFrame:
    """Add -1 for an anomaly and 1 for a normal row; NULL where there is no score."""
    decided = F.when(F.col("score") > threshold, rules.ANOMALY).when(F.col("score").isNotNull(), rules.NORMAL)
    return scored.withColumn("prediction", decided)


def predict(df: DataFrame, forest: Forest) -> DataFrame:
    return with_prediction(score(df, forest), forest.threshold)


def fit_tagged(
    extracted: DataFrame, keys: Sequence[str], spec: ForestSpec, min_rows: int = rules.MIN_TRAINING_ROWS, known: dict[str, Survey] | None = None
) -> dict[str, Fitted]:
    """Fit one forest per model id on the extracted rows (model_id, row_id and features) that carry it, all in the same jobs.

    Only complete rows count, and each set needs ``min_rows`` of them. The score threshold leaves
    the share ``contamination`` of them above it. ``known`` is the survey of these rows, if it was made already.
    """
    known = {key: (known or survey_tagged(extracted, keys, spec))[key] for key in keys}
    counts = {key: assert_enough(one.n_extracted, one.n_valid, min_rows) for key, one in known.items()}
    training = validate(extracted, spec.features)
    grown = grow(samples(candidates_tagged(training, known, spec), spec, len(keys)), spec)
    nodes = _fetch_nodes(grown, spec, len(keys))
    forests = {
        key: Forest(key, spec, min(spec.max_samples, counts[key]), nodes[nodes["model_id"] == key]) for key in keys
    }
    for forest in forests.values():
        assert_whole(forest)
    stage = materialise(score_tagged(training, forests, spec), "training-scores")
    try:
        thresholds = exact_quantile(stage.rows, "score", 1 - spec.contamination, "model_id", counts)
    except Exception:
        stage.discard()
        raise
    return {
        key: Fitted(
            replace(forest, threshold=thresholds[key]),
            counts[key],
            stage.rows.filter(F.col("model_id") == key),
            stage,
        )
        for key, forest in forests.items()
    }


def fit_many(
    extracted: dict[str, DataFrame], spec: ForestSpec, min_rows: int = rules.MIN_TRAINING_ROWS
) -> dict[str, Fitted]:
    """Fit one forest per set of extracted rows (row_id and features), all of them in the same jobs."""
    return fit_tagged(tagged(extracted, spec), list(extracted), spec, min_rows)


def fit(
    extracted: DataFrame, model_id: str, spec: ForestSpec = ForestSpec(), min_rows: int = rules.MIN_TRAINING_ROWS
) -> Fitted:
    """Fit a forest on the complete rows among the extracted ones."""
    return fit_many({model_id: extracted}, spec, min_rows)[model_id]
