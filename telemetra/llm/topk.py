"""Exact search for the highest inner products by a Voronoi join.

Data and queries are grouped by their nearest pivot. Summaries of the groups (size, radius, smallest distances to the
pivot) bound every inner product from both sides: with x in the group of pivot p, q.x lies within |q| |x - p| of q.p.
So each query knows a score that its results reach at least, and which groups can hold one of them. A group's
rows are copied only to the blocks of queries that need it, and solved there, piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.sources.scans import materialise

PIVOTS = 64
# Queries of a block, and data rows of a piece of a group, at most about.
BLOCK, PIECE = 8_192, 4_096
# Queries of a block that are multiplied with a piece at a time.
ROWS = 512
SCALE = 256
LOWEST, HIGHEST = -(2**63), 2**63 - 1
PLACED = "vec_id long, is_query boolean, cell int, distance double, packed binary"


@dataclass(frozen=True)
class Cells:
    """Pivots and the summaries of their groups. ``nearest`` has the smallest distances, filled up with infinity."""

    pivots: np.ndarray
    size: np.ndarray
    radius: np.ndarray
    nearest: np.ndarray


def _pack(vector: np.ndarray) -> bytes:
    """Whole numbers in the smallest of a few types, which the first byte names."""
    largest = np.abs(vector).max(initial=0)
    kind = "h" if largest < 2**15 else "i" if largest < 2**31 else "d"
    return kind.encode() + vector.astype("<" + kind).tobytes()


def _unpack(packed: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    result = np.zeros((len(packed), width))
    for row, data in zip(result, packed):
        values = np.frombuffer(data, "<" + data[:1].decode(), offset=1)
        row[: len(values)] = values
    return result


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    result = np.zeros((len(vectors), width))
    for row, values in zip(result, vectors):
        row[: len(values)] = values
    return result


def _place(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each point with its nearest pivot."""
    width = pivots.shape[1]

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["vector"], width)
            with np.errstate(all="ignore"):
                apart = np.nan_to_num((x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1) - 2 * x @ pivots.T, nan=np.inf)
                cell = apart.argmin(axis=1)
                distance = np.nan_to_num(np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1)), nan=np.inf)
            packed = [_pack(np.asarray(values, dtype=float)) for values in batch["vector"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "is_query": batch["is_query"], "cell": cell, "distance": distance, "packed": packed})

    return points.mapInPandas(nearest, PLACED)


def _summaries(placed: DataFrame, pivots: np.ndarray, k: int) -> Cells:
    """Sizes, radii and smallest distances by pivot. An id counts once among the distances, since results are ids."""
    n = len(pivots)
    size, radius, nearest = np.zeros(n, dtype=np.int64), np.zeros(n), np.full((n, k + 1), np.inf)
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius")).collect():
        size[r["cell"]], radius[r["cell"]] = r["n"], r["radius"]
    order = Window.partitionBy("cell").orderBy("distance")
    once = placed.groupBy("vec_id").agg(F.min(F.struct("distance", "cell")).alias("own")).select("own.*")
    lowest = once.select("cell", "distance", F.row_number().over(order).alias("place")).filter(F.col("place") <= k + 1)
    for r in lowest.collect():
        nearest[r["cell"], r["place"] - 1] = r["distance"]
    return Cells(pivots, size, radius, nearest)


def _needs(q: np.ndarray, cells: Cells, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each query, a score that k rows beside its own reach at least, and the groups that may hold a better one."""
    with np.errstate(all="ignore"):
        length = np.sqrt((q**2).sum(axis=1))[:, None]
        middle = q @ cells.pivots.T
        slack = 1e-9 * (np.abs(middle) + length * (cells.radius + 1)) + 1e-6
        low = (middle - slack)[:, :, None] - length[:, :, None] * cells.nearest
        low = np.nan_to_num(low, nan=-np.inf, posinf=-np.inf).reshape(len(q), -1)
        # One of the k + 1 best bounds may be that of the query's own row.
        least = -np.sort(-low, axis=1)[:, k] if low.shape[1] > k else np.full(len(q), -np.inf)
        high = np.nan_to_num(middle + slack + length * cells.radius, nan=np.inf)
    wanted = (high >= least[:, None]) & (cells.size > 0)
    # Scores stop at 64 bits.
    return np.minimum(least, float(HIGHEST)), [np.flatnonzero(row).astype(np.int32) for row in wanted]


def _blocks(n_queries: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of the queries of each group: neighbours share one, large groups have several."""
    first, count = np.zeros(len(n_queries), dtype=np.int64), np.ones(len(n_queries), dtype=np.int64)
    number, filled = 0, 0
    for cell, n in enumerate(n_queries):
        if filled and filled + n > block:
            number, filled = number + 1, 0
        first[cell], count[cell] = number, max(1, -(-n // block))
        if count[cell] > 1:
            number, filled = number + count[cell], 0
        else:
            filled += n
    return first, count


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; those beyond 64 bits become the nearest number with 64 bits."""
    largest = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1])
    if largest < 2**53:
        return (q @ x.T).astype(np.int64)
    whole = [[int(v) for v in row] for row in x]
    return np.array([[min(max(sum(int(a) * b for a, b in zip(row, other)), LOWEST), HIGHEST) for other in whole] for row in q], dtype=np.int64).reshape(len(q), len(x))


def _best(queries: pd.DataFrame, rows: pd.DataFrame, width: int, k: int) -> pd.DataFrame:
    """The k best rows of a piece for each query, ties to the smaller id, without those that cannot be results."""
    rows = rows.drop_duplicates(["vec_id", "packed"]).sort_values("vec_id", kind="stable")
    x, ids = _unpack(rows["packed"].tolist(), width), rows["vec_id"].to_numpy()
    found = []
    for begin in range(0, len(queries), ROWS):
        part = queries.iloc[begin : begin + ROWS]
        own, least = part["vec_id"].to_numpy(), part["least"].to_numpy()
        scores = _scores(_unpack(part["packed"].tolist(), width), x)
        good = (ids != own[:, None]) & ~(scores < least[:, None])
        for row in np.flatnonzero(good.any(axis=1)):
            at = np.flatnonzero(good[row])
            values = scores[row, at]
            if len(at) > k:
                keep = values >= np.partition(values, len(at) - k)[len(at) - k]
                at, values = at[keep], values[keep]
            top = np.argsort(-values, kind="stable") if len(at) and values.min() > LOWEST else np.array(sorted(range(len(at)), key=lambda i: -int(values[i])))
            # Several rows of one id may be among them; only its best counts.
            seen = set()
            for i in top:
                if len(seen) == k:
                    break
                if ids[at[i]] not in seen:
                    seen.add(ids[at[i]])
                    found.append((own[row], ids[at[i]], values[i]))
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, n_pivots: int = PIVOTS, block: int = BLOCK, piece: int = PIECE, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row that ``is_query`` marks, the k best others.

    Components x count as floor(256 x). Rows without an id, and vectors that are null or hold null or non-finite components, take
    no part; shorter vectors are filled up with zeros. Ties go to the smaller id. Repeated rows count once; where an id
    has several vectors, the best score of any of them counts, as data and as query.
    """
    finite = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector_column, lambda x: x.cast("double"))
    points = vectors.select(F.col(id_column).cast("long").alias("vec_id"), is_query.alias("is_query"), whole.alias("vector"), finite.alias("finite"))
    points = points.filter("vec_id is not null and vector is not null and finite").select("vec_id", F.coalesce("is_query", F.lit(False)).alias("is_query"), "vector")
    scaled = points.withColumn("vector", _floor(F.col("vector")))
    width = max(1, scaled.agg(F.max(F.size("vector"))).first()[0] or 0)
    chosen = scaled.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n_pivots).select("vector").collect()
    pivots = _matrix(pd.Series([r["vector"] for r in chosen], dtype=object), width)
    if not len(pivots):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    placed = materialise(_place(scaled, pivots), "topk-cells").until_exit()
    cells = _summaries(placed, pivots, k)
    queries = placed.filter("is_query")
    n_queries = np.zeros(len(pivots), dtype=np.int64)
    for r in queries.groupBy("cell").count().collect():
        n_queries[r["cell"]] = r["count"]
    first, n_blocks = _blocks(n_queries, block)

    def needs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell = batch["cell"].to_numpy()
            least, wanted = _needs(_unpack(batch["packed"].tolist(), width), cells, k)
            blocks = first[cell] + np.abs(batch["vec_id"].to_numpy() // 7) % n_blocks[cell]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "block": blocks, "least": least, "packed": batch["packed"], "cell": wanted})

    asked = materialise(queries.mapInPandas(needs, "vec_id long, block int, least double, packed binary, cell array<int>"), "topk-queries").until_exit()
    n_pieces = -(-np.maximum(cells.size, 1) // piece)
    pieces_of = F.element_at(F.array(*[F.lit(int(n)) for n in n_pieces]), F.col("cell") + 1)
    wanted = asked.select(F.col("block").alias("to"), F.explode("cell").alias("cell")).distinct()
    data = placed.select("vec_id", "cell", "packed").withColumn("piece", F.pmod(F.xxhash64("vec_id"), pieces_of.cast("long")).cast("int"))
    # At most a row for each group and block of queries.
    copied = data.join(wanted, "cell").select(F.col("to").alias("block"), "cell", "piece", "vec_id", "packed")
    sent = asked.select("vec_id", "block", "least", "packed", F.explode("cell").alias("cell"))
    sent = sent.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces_of - 1)))

    def solve(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        return _best(queries, rows, width, k)

    keys = ("block", "cell", "piece")
    found = sent.groupBy(*keys).cogroup(copied.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _floor(vector: Column) -> Column:
    """floor(256 x) of each component, as whole doubles: multiples of a power of two are exact."""

    @F.pandas_udf("array<double>")
    def scaled(vectors: pd.Series) -> pd.Series:
        return pd.Series([np.floor(SCALE * np.asarray(v, dtype=float)) for v in vectors], dtype=object)

    return scaled(vector)
