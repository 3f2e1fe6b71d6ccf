"""Benchmark passages in documents, up to small edits.

Windows of a document that are as long as an item are embedded by CGK random walks, which map edit distance to
Hamming distance; bit-sampling hashes of the embedding, repeated over several walks, propose pairs of window and
item, and an exact edit distance decides. All of it happens where the document is: nothing is shuffled.

A document holds an item if some run of its words is within an edit distance (in words) of ``(1 - similarity)`` times
the item's length. Words are runs of letters, digits and underscores in lower case; white space and punctuation part them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import repeat


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIMILARITY = 0.8
# Shorter items have no room for an edit: they are found where their words stand as they are.
MIN_WORDS = 5
# Items are sent to the executors in blocks of at most this many characters, one pass over the documents each.
BLOCK_CHARS = 4_000_000
# Walks over windows of up to so many words, and as many more for each further so many; hashes of each walk, sampled places of each hash.
# A window whose embedding agrees with that of an item in a share s of the places is found with probability
# 1 - (1 - s ** PLACES) ** (walks * HASHES); see ``recall``. The share falls as items grow, so long ones need more walks.
WALKS, WALKED_WORDS, HASHES, PLACES = 8, 100, 16, 3
# Random bits that are kept as a table, in bytes; those of larger classes are computed at every step.
TABLE_BYTES = 1 << 25
SEED = 20240607
# Items are treated together if their lengths differ by less than this factor; the shortest gives the window.
LENGTH_STEP = 1.2
# Windows embedded, pairs checked and words of documents searched at a time, which bounds memory.
WINDOWS, PAIRS, WORDS = 16_384, 16_384, 262_144
# What parts words: all of ASCII but letters, digits and underscore, and the punctuation and spaces of other scripts.
PARTING = bytes(c if c >= 128 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
WIDE_PARTING = re.compile("[\u0080-\u00a9\u00ab-\u00b1\u00b4\u00b6-\u00b8\u00bb\u00bf\u1680\u2000-\u206f\u2e00-\u2e7f\u3000-\u3003\u3008-\u3020\ufe30-\ufe6f\uff01-\uff0f]")
FOUND = "array<struct<item_id:long,start:int,end:int,edits:int>>"


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, in UTF-8."""
    if not text:
        return []
    lower = text.lower()
    if not lower.isascii():
        lower = WIDE_PARTING.sub(" ", lower)
    return lower.encode("utf-8", "surrogatepass").translate(PARTING).split()


def walks_of(window: int) -> int:
    """Number of walks over windows of a length."""
    return WALKS * max(1, -(-window // WALKED_WORDS))


def recall(agreement: float, window: int = WALKED_WORDS) -> float:
    """Chance that a window is proposed whose embedding agrees in this share of places."""
    return 1 - (1 - agreement**PLACES) ** (walks_of(window) * HASHES)


class Turns:
    """The random bits of walks: one for each walk, step and symbol, by a hash of the three."""

    def __init__(self, steps: int, n_symbols: int, n_walks: int) -> None:
        self.table: np.ndarray | None = None
        if steps * n_symbols * n_walks <= TABLE_BYTES:
            symbols = np.arange(n_symbols)
            self.table = np.array([[self._bits(walk, step, symbols) for step in range(steps)] for walk in range(n_walks)])

    @staticmethod
    def _bits(walk: int, step: int, symbols: np.ndarray) -> np.ndarray:
        key = symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(((SEED + walk) << 24) + step)
        key = (key ^ (key >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        key = (key ^ (key >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (key >> np.uint64(63)).astype(np.int8)

    def of(self, walk: int, step: int, symbols: np.ndarray) -> np.ndarray:
        return self.table[walk, step, symbols] if self.table is not None else self._bits(walk, step, symbols)


@dataclass(frozen=True)
class LengthClass:
    """Items of about the same length, and the index of their hashes."""

    window: int
    most_edits: int
    items: list[tuple[int, np.ndarray]]
    member: np.ndarray
    turns: Turns = field(repr=False)
    places: np.ndarray = field(repr=False)
    # Each item's words, as item times the number of words plus word, sorted.
    pairs: np.ndarray = field(repr=False)
    keys: list[np.ndarray] = field(repr=False)
    owners: list[np.ndarray] = field(repr=False)


def _walk(symbols: np.ndarray, starts: np.ndarray, window: int, turns: Turns, walk: int, places: np.ndarray) -> np.ndarray:
    """Bit-sampling hashes of the CGK embeddings of windows, one column for each hash of this walk.

    In every step the walk writes the symbol it stands on and moves on if that symbol's random bit of the step is set.
    Past its end a window reads zeros.
    """
    steps = int(places.max()) + 1
    sampled = {int(step): np.zeros(len(starts), dtype=np.int64) for step in np.unique(places)}
    at, end = starts.copy(), starts + window
    for step in range(steps):
        symbol = np.where(at < end, symbols[np.minimum(at, len(symbols) - 1)], 0)
        if step in sampled:
            sampled[step] = symbol.astype(np.int64)
        at += turns.of(walk, step, symbol)
    hashes = np.empty((len(starts), len(places)), dtype=np.uint64)
    for i, chosen in enumerate(places):
        key = np.full(len(starts), 1469598103934665603 + i, dtype=np.uint64)
        for step in chosen:
            key = (key ^ sampled[int(step)].astype(np.uint64)) * np.uint64(1099511628211)
            key ^= key >> np.uint64(29)
        hashes[:, i] = key
    return hashes


def _edits(text: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Smallest edit distance of the item to any run of the text, and where such a run ends (Sellers)."""
    n = len(text)
    place = np.arange(n + 1)
    row = np.zeros(n + 1, dtype=np.int64)
    for i, word in enumerate(item, 1):
        best = np.empty(n + 1, dtype=np.int64)
        best[0] = i
        np.minimum(row[:-1] + (text != word), row[1:] + 1, out=best[1:])
        row = np.minimum.accumulate(best - place) + place
    end = int(row.argmin())
    return int(row[end]), end


def _classes(items: list[tuple[int, np.ndarray]], n_words: int, similarity: float) -> list[LengthClass]:
    """Group items by length and index their embeddings."""
    rng = np.random.default_rng(SEED)
    items = sorted(items, key=lambda item: (len(item[1]), item[0]))
    result = []
    while items:
        window = len(items[0][1])
        group = [item for item in items if len(item[1]) <= max(window, int(window * LENGTH_STEP))]
        items = items[len(group) :]
        n_walks = walks_of(window)
        places = np.sort(rng.integers(0, max(1, 2 * window), (n_walks, HASHES, PLACES)), axis=2)
        turns = Turns(int(places.max()) + 1, n_words + 1, n_walks)
        member = np.zeros(n_words + 1, dtype=bool)
        joined = np.concatenate([words[:window] for _, words in group])
        for _, words in group:
            member[words] = True
        starts = np.arange(len(group)) * window
        keys, owners = [], []
        for walk in range(n_walks):
            hashes = _walk(joined, starts, window, turns, walk, places[walk])
            order = np.argsort(hashes, axis=0, kind="stable")
            keys.append(np.take_along_axis(hashes, order, axis=0).T.copy())
            owners.append(order.T.copy())
        most = int((1 - similarity) * len(group[-1][1]) + 1e-9)
        pairs = np.unique(np.concatenate([number * len(member) + words.astype(np.int64) for number, (_, words) in enumerate(group)]))
        result.append(LengthClass(window, most, group, member, turns, places, pairs, keys, owners))
    return result


def _proposed(one: LengthClass, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Pairs (place in ``starts``, item) that share a hash, without repeats."""
    pairs = []
    for walk in range(len(one.places)):
        hashes = _walk(symbols, starts, one.window, one.turns, walk, one.places[walk])
        for i in range(HASHES):
            keys, owners = one.keys[walk][i], one.owners[walk][i]
            low = np.searchsorted(keys, hashes[:, i], "left")
            n = np.searchsorted(keys, hashes[:, i], "right") - low
            hit = np.flatnonzero(n)
            if len(hit):
                repeated = np.repeat(hit, n[hit])
                offset = np.arange(len(repeated)) - np.repeat(np.cumsum(n[hit]) - n[hit], n[hit])
                pairs.append(repeated * len(one.items) + owners[low[repeated] + offset])
    return np.unique(np.concatenate(pairs)) if pairs else np.empty(0, dtype=np.int64)


def _likely(one: LengthClass, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, pairs: np.ndarray, similarity: float) -> np.ndarray:
    """Of pairs (start, item), those that can match: each word strange to the item, and each of its words missing, is an edit."""
    window, item = np.divmod(pairs, len(one.items))
    allowed = np.array([int((1 - similarity) * len(words) + 1e-9) for _, words in one.items])
    at = starts[window][:, None] + np.arange(one.window)
    code = item[:, None] * len(one.member) + symbols[np.minimum(at, len(symbols) - 1)]
    place = np.minimum(np.searchsorted(one.pairs, code), len(one.pairs) - 1)
    known = (one.pairs[place] == code) & (at < ends[window][:, None])
    likely = one.window - known.sum(axis=1) <= allowed[item]
    pairs, window, item = pairs[likely], window[likely], item[likely]
    # A longer window for the words missing: the match may be longer by its edits.
    at = starts[window][:, None] + np.arange(max(len(words) for _, words in one.items) + one.most_edits)
    code = item[:, None] * len(one.member) + symbols[np.minimum(at, len(symbols) - 1)]
    place = np.minimum(np.searchsorted(one.pairs, code), len(one.pairs) - 1)
    code = np.sort(np.where((one.pairs[place] == code) & (at < ends[window][:, None]), code, -1), axis=1)
    n_distinct = (code[:, 0] >= 0) + ((code[:, 1:] != code[:, :-1]) & (code[:, 1:] >= 0)).sum(axis=1)
    wanted = np.bincount(one.pairs // len(one.member), minlength=len(one.items))
    return pairs[wanted[item] - n_distinct <= allowed[item]]


@dataclass(frozen=True)
class Short:
    """Items of one length that are too short for an edit, with sorted hashes of their words."""

    length: int
    keys: np.ndarray
    ids: np.ndarray
    words: np.ndarray


def _hashes(columns: list[np.ndarray]) -> np.ndarray:
    key = np.zeros(len(columns[0]), dtype=np.uint64)
    for column in columns:
        key = (key ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(32)
    return key


def _short(items: list[tuple[int, np.ndarray]]) -> list[Short]:
    result = []
    for length in sorted({len(words) for _, words in items}):
        same = [item for item in items if len(item[1]) == length]
        words = np.array([words for _, words in same])
        keys = _hashes(list(words.T))
        order = np.argsort(keys, kind="stable")
        result.append(Short(length, keys[order], np.array([item_id for item_id, _ in same])[order], words[order]))
    return result


def _exact(one: Short, joined: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, tuple[int, int, int, int]]]:
    """(document, match) of every place where a short item's words stand, in the order of places."""
    columns = [joined[i : len(joined) - one.length + 1 + i] for i in range(one.length)]
    if not len(columns[0]):
        return
    hashes = _hashes(columns)
    low, high = np.searchsorted(one.keys, hashes, "left"), np.searchsorted(one.keys, hashes, "right")
    for start in np.flatnonzero(high > low).tolist():
        document = int(np.searchsorted(ends, start, "right"))
        if document >= len(ends) or start + one.length > ends[document]:
            continue
        at = start - int(ends[document] - lengths[document])
        for i in range(low[start], high[start]):
            if (joined[start : start + one.length] == one.words[i]).all():
                yield document, (int(one.ids[i]), at, at + one.length, 0)


def _search(documents: list[np.ndarray], classes: list[LengthClass], similarity: float, short: Sequence[Short] = ()) -> list[list[tuple[int, int, int, int]]]:
    """(item, start, end, edits) found in each of some documents, given as word numbers (zero for words of no item)."""
    found: list[dict[int, tuple[int, int, int, int]]] = [{} for _ in documents]
    lengths = np.array([len(words) for words in documents])
    ends = np.cumsum(lengths)
    widest = max((one.window for one in classes), default=0)
    joined = np.concatenate([*documents, np.zeros(widest, dtype=np.int32)])
    for few_words in short:
        for document, match in _exact(few_words, joined, ends, lengths):
            found[document].setdefault(match[0], match)
    for one in classes:
        # A window that matches has no more strange words than edits are allowed.
        known = one.member[joined]
        strange = np.concatenate((np.zeros(1, dtype=np.int32), np.cumsum(~known, dtype=np.int32)))
        few = strange[one.window :] - strange[: -one.window] <= one.most_edits
        starts = np.flatnonzero(few & known[: len(few)])
        owner = np.searchsorted(ends, starts, "right")
        starts, owner = starts[owner < len(ends)], owner[owner < len(ends)]
        # What is left of the document must be long enough for the shortest item with all its edits.
        fits = starts + one.window - one.most_edits <= ends[owner]
        starts, owner = starts[fits], owner[fits]
        for begin in range(0, len(starts), WINDOWS):
            part, part_owner = starts[begin : begin + WINDOWS], owner[begin : begin + WINDOWS]
            proposed = _proposed(one, joined, part)
            for first in range(0, len(proposed), PAIRS):
                for pair in _likely(one, joined, part, ends[part_owner], proposed[first : first + PAIRS], similarity).tolist():
                    window, number = divmod(pair, len(one.items))
                    item_id, words = one.items[number]
                    document = int(part_owner[window])
                    if item_id in found[document]:
                        continue
                    allowed = int((1 - similarity) * len(words) + 1e-9)
                    top, end = int(ends[document] - lengths[document]), int(ends[document])
                    low = max(top, int(part[window]) - allowed)
                    edits, last = _edits(joined[low : min(end, int(part[window]) + len(words) + 2 * allowed)], words)
                    if edits <= allowed:
                        found[document][item_id] = (item_id, max(top, low + last - len(words)) - top, low + last - top, edits)
    return [sorted(matches.values()) for matches in found]


def _in_parts(texts: pd.Series, vocabulary: dict[bytes, int]) -> Iterator[list[np.ndarray]]:
    """Texts as word numbers, some texts at a time."""
    part, size = [], 0
    for text in texts:
        words = words_of(text)
        part.append(np.fromiter(map(vocabulary.get, words, repeat(0)), np.int32, len(words)))
        size += len(words)
        if size >= WORDS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, list[bytes]]]]:
    """Items (id, words) in blocks of about a size; those without a word or id are left out, repeats count once.

    All texts of an id are in one block, so that it is found once.
    """
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").dropna().distinct().orderBy("item_id", "text").toLocalIterator():
        words = words_of(row["text"])
        if not words:
            continue
        if block and size + len(row["text"]) > BLOCK_CHARS and block[-1][0] != row["item_id"]:
            yield block
            block, size = [], 0
        block.append((row["item_id"], words))
        size += len(row["text"])
    if block:
        yield block


def find_items(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, text_column: str = "text", to: str = "items") -> DataFrame:
    """Add the column ``to``: an array of (item_id, start, end, edits) in words, by item; empty if there is none.

    Null and empty texts hold no item; an item of several rows with one id is found if one of its texts is. An edited
    run's start is its end less the item's length. Every other column stays as it is.
    """
    found = [_finder(docs.sparkSession, block, similarity)(F.col(text_column)) for block in _blocks(benchmark)]
    if not found:
        found = [F.array().cast(FOUND)]
    return docs.withColumn(to, F.concat(*found) if len(found) > 1 else found[0])


def _finder(spark: SparkSession, block: list[tuple[int, list[bytes]]], similarity: float) -> Callable[[Column], Column]:
    """A function of a text column that finds the items of one block."""
    vocabulary = {word: i for i, word in enumerate(sorted({word for _, words in block for word in words}), 1)}
    numbered = [(item_id, np.array([vocabulary[word] for word in words], dtype=np.int32)) for item_id, words in block]
    shared = spark.sparkContext.broadcast((vocabulary, numbered))

    @F.pandas_udf(FOUND)
    def items(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary, numbered = shared.value
        classes = _classes([item for item in numbered if len(item[1]) >= MIN_WORDS], len(vocabulary), similarity)
        short = _short([item for item in numbered if len(item[1]) < MIN_WORDS])
        for texts in batches:
            found = [matches for part in _in_parts(texts, vocabulary) for matches in _search(part, classes, similarity, short)]
            yield pd.Series([[dict(zip(("item_id", "start", "end", "edits"), match)) for match in matches] for matches in found])

    return items
