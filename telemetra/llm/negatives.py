"""Hard negatives by best-first search in an R-tree packed by sort-tile-recursive order.

Rows are sorted by label and cut into slabs, these by one coordinate and then another (sort-tile-recursive, with cuts from a bounded
sample), which gives the tree's upper boxes. Each holds pages of a bounded number of rows; a page is packed the same way into leaves, with
minimum bounding boxes over leaves and over groups of leaves. A box bounds each coordinate, so it bounds the inner product with
an anchor from both sides. Boxes outside an anchor's score windows, with no label it may meet, or strictly below its k-th
score so far are left out: first each anchor visits its most promising box, then, knowing its k-th score, all others that may
hold a result. Within a page a queue takes the box with the highest bound next.

Anchors travel in blocks to copies of the pages they need, so no task holds more than a block and a page.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm.topk import HIGHEST, LOWEST, _blocks, _floor, _matrix, _scores
from telemetra.sources.scans import Staged, materialise

# Upper boxes at most, rows of a page and of a leaf at most about, leaves of an inner box.
TILES, PAGE, LEAF, FAN = 256, 4_096, 64, 8
# Rows that the cuts between upper boxes are taken from, at most.
SAMPLE = 4_096
# Anchors of a block, at most about.
BLOCK = 4_096
POSITIVES, NEGATIVES = 5, 3
# A negative's score lies between these percentages of the positive's.
LOW_PERCENT, HIGH_PERCENT = 50, 95

ASK = "anchor_id long, label long, cell int, vector array<double>, lows array<long>, highs array<long>, floors array<long>"
FOUND = "anchor_id long, part int, vec_id long, score long"
PAGES = "cell int, piece int, n int, ids binary, labels binary, vectors binary, first long, last long, low array<double>, high array<double>"


def _spread(x: np.ndarray) -> list[int]:
    """Coordinates, those that differ most first."""
    return np.argsort(-x.std(axis=0), kind="stable").tolist() if len(x) else []


def _slab(n: int, leaves: int, left: int) -> int:
    """Rows of a slab when ``left`` sorts remain, so that all of them together make leaves."""
    slabs = max(1, round(leaves ** (1 / left)))
    return -(-n // slabs)


def str_order(x: np.ndarray, labels: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Places of the rows in sort-tile-recursive order: by label, then slab by slab by the coordinates that differ most."""
    keys = [labels, *(x[:, c] for c in _spread(x)[:3])]

    def tiled(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        rows = rows[np.argsort(keys[depth][rows], kind="stable")]
        if depth + 1 == len(keys) or len(rows) <= leaf:
            return [rows]
        slab = _slab(len(rows), -(-len(rows) // leaf), len(keys) - depth)
        return [part for at in range(0, len(rows), slab) for part in tiled(rows[at : at + slab], depth + 1)]

    return np.concatenate(tiled(np.arange(len(x)), 0)) if len(x) else np.zeros(0, dtype=int)


@dataclass(frozen=True)
class Cuts:
    """Cuts of one key (-1: the label, else a coordinate) into slabs, each with cuts of the next key or the number of its box."""

    key: int
    at: np.ndarray
    slabs: list[Cuts | int]

    def place(self, x: np.ndarray, labels: np.ndarray) -> np.ndarray:
        result = np.zeros(len(x), dtype=np.int32)
        slab = np.searchsorted(self.at, labels if self.key < 0 else x[:, self.key], side="right")
        for i in np.unique(slab):
            rows = np.flatnonzero(slab == i)
            inside = self.slabs[i]
            result[rows] = inside if isinstance(inside, int) else inside.place(x[rows], labels[rows])
        return result


def cut(x: np.ndarray, labels: np.ndarray, tiles: int) -> Cuts:
    """Cuts of a sample into at most so many boxes: by label as far as labels go, then by two coordinates."""
    coordinates = _spread(x)[:2]
    keys = [-1, *coordinates]
    number = iter(range(tiles))

    def cuts(rows: np.ndarray, depth: int, most: int) -> Cuts | int:
        if depth == len(keys) or most <= 1 or not len(rows):
            return next(number)
        values = np.sort(labels[rows] if keys[depth] < 0 else x[rows, keys[depth]])
        wanted = most if depth == 0 or depth + 1 == len(keys) else max(1, round(most**0.5))
        at = np.unique(values[[len(values) * i // wanted for i in range(1, wanted)]])
        at = at[at > values[0]]
        slab = np.searchsorted(at, labels[rows] if keys[depth] < 0 else x[rows, keys[depth]], side="right")
        return Cuts(keys[depth], at, [cuts(rows[slab == i], depth + 1, most // (len(at) + 1)) for i in range(len(at) + 1)])

    whole = cuts(np.arange(len(x)), 0, tiles)
    return whole if isinstance(whole, Cuts) else Cuts(-1, np.zeros(0), [whole])


@dataclass
class Boxes:
    """Minimum bounding boxes, with the lowest and highest label of each."""

    low: np.ndarray
    high: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest inner product of each query with anything in each box, a little wider than exact."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        with np.errstate(all="ignore"):
            most = np.abs(q) @ np.maximum(np.abs(self.low), np.abs(self.high)).T
            slack = 1e-9 * most + 1e-6
            least = up @ self.low.T + down @ self.high.T - slack
            return np.nan_to_num(least, nan=-np.inf), np.nan_to_num(up @ self.high.T + down @ self.low.T + slack, nan=np.inf)

    def part(self, some: slice) -> Boxes:
        return Boxes(self.low[some], self.high[some], self.first[some], self.last[some])

    def over(self, groups: np.ndarray) -> Boxes:
        """Boxes around neighbouring ones; ``groups`` has the first of each group."""
        return Boxes(np.minimum.reduceat(self.low, groups), np.maximum.reduceat(self.high, groups), np.minimum.reduceat(self.first, groups), np.maximum.reduceat(self.last, groups))


@dataclass
class Asks:
    """Queries of a block. Each has windows of scores, and floors: what it knows its k-th score in a window to be at least."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    lows: np.ndarray
    highs: np.ndarray
    floors: np.ndarray

    def want(self, boxes: Boxes, least: np.ndarray, most: np.ndarray, same: bool) -> np.ndarray:
        """Whether each query may find something in each box."""
        label = self.labels[:, None]
        meets = (boxes.first <= label) & (label <= boxes.last) if same else (boxes.first != label) | (boxes.last != label)
        needed = np.maximum(self.lows, self.floors).astype(float)
        inside = (most[:, :, None] >= needed[:, None, :]) & (least[:, :, None] <= self.highs.astype(float)[:, None, :])
        return meets & inside.any(axis=2)

    def some(self, rows: np.ndarray) -> Asks:
        return Asks(self.ids[rows], self.labels[rows], self.vectors[rows], self.lows[rows], self.highs[rows], self.floors[rows])


class Page:
    """A page's part of the tree: its rows in leaves of neighbours, boxes over leaves, and boxes over those."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> None:
        self.ids, self.labels, self.vectors, self.leaf, self.fan = ids, labels, vectors, leaf, fan
        rows = Boxes(vectors, vectors, labels, labels)
        self.leaves = rows.over(np.arange(0, len(ids), leaf))
        self.inner = self.leaves.over(np.arange(0, len(self.leaves.first), fan))
        self.visited = 0

    def search(self, asks: Asks, same: bool, k: int) -> list[tuple[int, int, int, int]]:
        """The k best rows (anchor_id, window, vec_id, score) of each query in each of its windows, ties to the smaller id."""
        n_windows = asks.lows.shape[1]
        best = np.full((len(asks.ids), n_windows, k), LOWEST, dtype=np.int64)
        found: list[tuple[np.ndarray, ...]] = []
        least, most = self.inner.bounds(asks.vectors)
        # Boxes by their highest bound over all queries that want them: (bound, is a leaf, number, queries).
        queue: list[tuple[float, int, int, np.ndarray]] = []

        def push(bounds: np.ndarray, want: np.ndarray, rows: np.ndarray, is_leaf: int, first: int) -> None:
            for i in np.flatnonzero(want.any(axis=0)):
                some = want[:, i]
                heapq.heappush(queue, (-float(bounds[some, i].max()), is_leaf, first + int(i), rows[some]))

        push(most, asks.want(self.inner, least, most, same), np.arange(len(asks.ids)), 0, 0)
        while queue:
            _, is_leaf, number, rows = heapq.heappop(queue)
            part = asks.some(rows)
            boxes = self.leaves.part(slice(number, number + 1) if is_leaf else slice(number * self.fan, (number + 1) * self.fan))
            least, most = boxes.bounds(part.vectors)
            # The floors may have risen since the box was put into the queue.
            wanted = part.want(boxes, least, most, same)
            if not is_leaf:
                push(most, wanted, rows, 1, number * self.fan)
                continue
            rows, part = rows[wanted[:, 0]], part.some(wanted[:, 0])
            if not len(rows):
                continue
            self.visited += len(rows)
            here = slice(number * self.leaf, (number + 1) * self.leaf)
            ids, labels = self.ids[here], self.labels[here]
            scores = _scores(part.vectors, self.vectors[here])
            good = ((labels == part.labels[:, None]) == same) & (ids != part.ids[:, None])
            for window in range(n_windows):
                lowest = np.maximum(part.lows[:, window], part.floors[:, window])
                hit = good & (scores >= lowest[:, None]) & (scores <= part.highs[:, window, None])
                if not hit.any():
                    continue
                # The k best of the leaf, whose rows stand by id, so that ties go to the smaller one.
                order = np.lexsort((~scores, ~hit), axis=1)[:, :k]
                value, there = np.take_along_axis(scores, order, axis=1), np.take_along_axis(hit, order, axis=1)
                at, column = np.nonzero(there)
                found.append((rows[at], np.full(len(at), window), ids[order[at, column]], value[at, column]))
                top = np.concatenate([best[rows, window], np.where(there, value, LOWEST)], axis=1)
                best[rows, window] = np.partition(top, top.shape[1] - k, axis=1)[:, -k:]
                asks.floors[rows, window] = np.maximum(asks.floors[rows, window], best[rows, window].min(axis=1))
        return _best(found, asks, k)


def _best(found: list[tuple[np.ndarray, ...]], asks: Asks, k: int) -> list[tuple[int, int, int, int]]:
    """The k best of each query and window."""
    if not found:
        return []
    row, window, ids, scores = (np.concatenate(column) for column in zip(*found))
    good = scores >= asks.floors[row, window]
    row, window, ids, scores = row[good], window[good], ids[good], scores[good]
    # Highest scores first: the complement of a number turns the order round and has no overflow.
    order = np.lexsort((ids, ~scores, window, row))
    row, window, ids, scores = row[order], window[order], ids[order], scores[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (window[1:] != window[:-1])]
    first = np.maximum.accumulate(np.where(new, np.arange(len(row)), 0))
    keep = np.arange(len(row)) - first < k
    return list(zip(asks.ids[row[keep]].tolist(), window[keep].tolist(), ids[keep].tolist(), scores[keep].tolist()))


def _numbers(matrix: np.ndarray) -> bytes:
    """Whole numbers in the smallest of a few types, which the first byte names."""
    largest = np.abs(matrix).max(initial=0)
    kind = "h" if largest < 2**15 else "i" if largest < 2**31 else "d"
    return kind.encode() + matrix.astype("<" + kind).tobytes()


def _page(row: pd.Series, width: int) -> Page:
    packed = row["vectors"]
    vectors = np.frombuffer(packed, "<" + packed[:1].decode(), offset=1).reshape(row["n"], width).astype(float)
    return Page(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), vectors)


def points_of(vectors: DataFrame, is_anchor: Column, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """Rows (vec_id, label, is_anchor, vector) that take part, with components floor(256 x)."""
    finite = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * 256) < float("inf")))
    whole = F.transform(vector_column, lambda x: x.cast("double"))
    named = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        whole.alias("vector"),
        finite.alias("finite"),
    )
    points = named.filter("vec_id is not null and label is not null and vector is not null and finite").drop("finite")
    return points.withColumn("vector", _floor(F.col("vector")))


def _once(points: DataFrame) -> DataFrame:
    """One row for each id: of several the one with the smallest label, then vector. Only rows of repeated ids are shuffled."""
    repeated = materialise(points.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("vec_id"), "negatives-repeated")
    if repeated.rows.isEmpty():
        repeated.discard()
        return points
    ids = repeated.until_exit()
    smallest = points.join(ids, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "vector", "is_anchor")).alias("own"))
    return points.join(ids, "vec_id", "left_anti").unionByName(smallest.select("vec_id", "own.*"))


@dataclass(frozen=True)
class Tree:
    """The packed tree: its pages as a table, and the upper boxes, of which there is a bounded number."""

    pages: Staged
    boxes: Boxes
    # Numbers of the upper boxes that hold rows, and pages of each.
    cells: np.ndarray
    pieces: np.ndarray
    width: int


def _array(values: pd.Series, width: int, kind: str = "int64") -> np.ndarray:
    return np.array(values.tolist(), dtype=kind).reshape(len(values), width)


def place(points: DataFrame, width: int, n_rows: int, tiles: int, page: int, sample: int) -> Staged:
    """Every row with its upper box."""
    drawn = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("label", "vector").collect()
    x = _matrix(pd.Series([r["vector"] for r in drawn], dtype=object), width)
    cuts = cut(x, np.array([r["label"] for r in drawn], dtype=np.int64), min(tiles, max(1, -(-n_rows // page))))

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(cell=cuts.place(_matrix(batch["vector"], width), batch["label"].to_numpy()))

    return materialise(points.mapInPandas(placed, "vec_id long, label long, is_anchor boolean, vector array<double>, cell int"), "negatives-rows")


def pack(placed: DataFrame, width: int, page: int) -> Tree:
    """Pages of every upper box; boxes with more rows than a page have several, dealt by hash of the id."""
    size = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    cells = np.array(sorted(size), dtype=np.int32)
    pieces = np.array([-(-size[c] // page) for c in sorted(size)], dtype=np.int64)
    n_pieces = F.element_at(F.create_map(*[F.lit(int(v)) for pair in zip(cells, pieces) for v in pair]), F.col("cell"))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        x, labels, ids = _matrix(rows["vector"], width), rows["label"].to_numpy(), rows["vec_id"].to_numpy()
        order = str_order(x, labels)
        order = np.concatenate([leaf[np.argsort(ids[leaf])] for leaf in np.split(order, range(LEAF, len(order), LEAF))])
        blobs = (ids[order].astype("<i8").tobytes(), labels[order].astype("<i8").tobytes(), _numbers(x[order]))
        edges = (labels.min(), labels.max(), x.min(axis=0), x.max(axis=0))
        return pd.DataFrame([(rows["cell"].iloc[0], rows["piece"].iloc[0], len(rows), *blobs, *edges)], columns=[name.split()[0] for name in PAGES.split(", ")])

    dealt = placed.withColumn("piece", F.pmod(F.xxhash64("vec_id"), n_pieces.cast("long")).cast("int"))
    pages = materialise(dealt.groupBy("cell", "piece").applyInPandas(packed, PAGES), "negatives-pages")
    at = {c: i for i, c in enumerate(cells.tolist())}
    n = len(cells)
    boxes = Boxes(np.full((n, width), np.inf), np.full((n, width), -np.inf), np.full(n, HIGHEST), np.full(n, LOWEST))
    for r in pages.rows.groupBy("cell").agg(F.min("first").alias("first"), F.max("last").alias("last")).collect():
        boxes.first[at[r["cell"]]], boxes.last[at[r["cell"]]] = r["first"], r["last"]
    sides = pages.rows.select("cell", F.posexplode(F.arrays_zip("low", "high")).alias("axis", "side"))
    for r in sides.groupBy("cell", "axis").agg(F.min("side.low").alias("low"), F.max("side.high").alias("high")).collect():
        boxes.low[at[r["cell"]], r["axis"]], boxes.high[at[r["cell"]], r["axis"]] = r["low"], r["high"]
    return Tree(pages, boxes, cells, pieces, width)


def _asks(batch: pd.DataFrame, width: int) -> Asks:
    n = len(batch["lows"].iloc[0]) if len(batch) else 0
    columns = [_array(batch[name], n) for name in ("lows", "highs", "floors")]
    return Asks(batch["anchor_id"].to_numpy(), batch["label"].to_numpy(), _matrix(batch["vector"], width), *columns)


def _ways(asks: DataFrame, tree: Tree, same: bool, known: DataFrame | None) -> DataFrame:
    """The upper boxes that each anchor visits: the most promising one, or with ``known`` floors all others that may hold a result."""
    boxes, cells, width, at_first = tree.boxes, tree.cells, tree.width, known is None

    def ways(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            # Anchors with different numbers of windows meet in a batch.
            for _, part in batch.groupby(batch["lows"].map(len)):
                some = _asks(part, width)
                least, most = boxes.bounds(some.vectors)
                first_floors = Asks(some.ids, some.labels, some.vectors, some.lows, some.highs, np.full_like(some.floors, LOWEST))
                promising = np.where(first_floors.want(boxes, least, most, same), most, -np.inf)
                top = promising.argmax(axis=1)
                if at_first:
                    to = [cells[i : i + int(row[i] > -np.inf)] for i, row in zip(top, promising)]
                else:
                    wanted = some.want(boxes, least, most, same)
                    wanted[np.arange(len(top)), top] = False
                    to = [cells[row] for row in wanted]
                yield part.assign(to=to)

    if known is not None:
        asks = asks.drop("floors").join(known, "anchor_id")
    return asks.select(*[name.split()[0] for name in ASK.split(", ")]).mapInPandas(ways, f"{ASK}, to array<int>")


def _visit(ways: DataFrame, tree: Tree, same: bool, k: int, block: int) -> DataFrame:
    """What anchors find in the pages of the upper boxes they visit."""
    width = tree.width
    sent = materialise(ways.filter(F.size("to") > 0), "negatives-asks").until_exit()
    counts = {r["cell"]: r["n"] for r in sent.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, n_blocks = _blocks(np.array([counts.get(c, 0) for c in range(max([0, *counts]) + 1)]), block)

    def listed(numbers: np.ndarray) -> Column:
        return F.element_at(F.array(*[F.lit(int(n)) for n in numbers]), F.col("cell") + 1)

    dealt = sent.withColumn("block", listed(first) + F.pmod(F.xxhash64("anchor_id"), listed(n_blocks).cast("long")))
    # At most a row for each upper box and block of anchors.
    meetings = dealt.select(F.col("block").alias("for"), F.explode("to").alias("cell")).distinct()
    copied = tree.pages.rows.join(meetings, "cell").withColumnRenamed("for", "block")
    n_pieces = F.element_at(F.create_map(*[F.lit(int(v)) for pair in zip(tree.cells, tree.pieces) for v in pair]), F.col("cell"))
    asked = dealt.drop("cell").withColumn("cell", F.explode("to")).drop("to").withColumn("piece", F.explode(F.sequence(F.lit(0), (n_pieces - 1).cast("int"))))

    def solve(asks: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        rows: list[tuple] = []
        for _, row in pages.iterrows():
            page = _page(row, width)
            for _, part in asks.groupby(asks["lows"].map(len)):
                rows += page.search(_asks(part, width), same, k)
        return pd.DataFrame(rows, columns=["anchor_id", "part", "vec_id", "score"]).astype("int64")

    keys = ("block", "cell", "piece")
    return asked.groupBy(*keys).cogroup(copied.groupBy(*keys)).applyInPandas(solve, FOUND)


def _k_best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "part").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(asks: DataFrame, tree: Tree, same: bool, k: int, block: int = BLOCK) -> DataFrame:
    """Rows (anchor_id, part, rank, vec_id, score): the k best rows for each anchor and window."""
    nearest = _k_best(materialise(_visit(_ways(asks, tree, same, None), tree, same, k, block), "negatives-first").until_exit(), k)
    reached = nearest.filter(F.col("rank") == k).select("anchor_id", F.struct("part", "score").alias("floor"))
    floors = reached.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list("floor")).alias("floors"))
    known = asks.select("anchor_id", F.size("lows").alias("n")).join(floors, "anchor_id", "left")
    of_part = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.coalesce(F.col("floors")[i], F.lit(LOWEST)))
    others = _visit(_ways(asks, tree, same, known.select("anchor_id", of_part.alias("floors"))), tree, same, k, block)
    both = nearest.drop("rank").unionByName(others)
    return _k_best(both, k).select("anchor_id", "part", "rank", "vec_id", "score")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    percent: tuple[int, int] = (LOW_PERCENT, HIGH_PERCENT),
    tiles: int = TILES,
    page: int = PAGE,
    block: int = BLOCK,
    sample: int = SAMPLE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A row's score is its inner product with the anchor, with components floor(256 x). An anchor's positives are the best other rows
    of its label, its negatives for one of them the best rows of other labels whose scores lie between two percentages of the
    positive's, both included; a negative score of a positive leaves none. Ties go to the smaller id.

    Rows without an id or label, and vectors that are null or hold null, non-finite or (256-fold) unbounded components, take no
    part; shorter vectors are filled up with zeros. Of several rows with one id the one with the smallest label, then vector, counts. Scores
    beyond 64 bits count as the nearest number with 64 bits. Other columns are not used, so their names don't matter.
    """
    spark = vectors.sparkSession
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    points = _once(points_of(vectors, is_anchor, id_column, vector_column, label_column))
    seen = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not seen["n"]:
        return spark.createDataFrame([], result)
    width = max(1, seen["width"])
    placed = place(points, width, seen["n"], tiles, page, sample)
    rows = placed.until_exit()
    tree = pack(rows, width, page)
    tree.pages.until_exit()

    anchors = rows.filter("is_anchor").select(F.col("vec_id").alias("anchor_id"), "label", "cell", "vector")
    everything = {"lows": LOWEST, "highs": HIGHEST, "floors": LOWEST}
    open_ = anchors.withColumns({name: F.array(F.lit(value).cast("long")) for name, value in everything.items()})
    positives = materialise(search(open_, tree, True, n_positives, block), "negatives-positives").until_exit()

    exact = F.col("score").cast("decimal(20,0)")
    low, high = (f(exact * F.lit(p).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")) for f, p in zip((F.ceil, F.floor), percent))
    limits = positives.filter("score >= 0").select("anchor_id", F.struct("rank", "vec_id", "score", low.cast("long").alias("low"), high.cast("long").alias("high")).alias("p"))
    by_anchor = limits.groupBy("anchor_id").agg(F.sort_array(F.collect_list("p")).alias("p"))
    windows = {"lows": F.col("p.low"), "highs": F.col("p.high"), "floors": F.transform("p", lambda _: F.lit(LOWEST).cast("long"))}
    asks = materialise(anchors.join(by_anchor, "anchor_id").withColumns(windows).drop("p"), "negatives-windows").until_exit()
    negatives = search(asks, tree, False, n_negatives, block)
    # Scores fall with the rank, so the windows are those of the first positives.
    known = positives.select("anchor_id", (F.col("rank") - 1).alias("part"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = negatives.withColumnRenamed("vec_id", "negative_id").withColumnRenamed("score", "negative_score").join(known, ["anchor_id", "part"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
