"""Near-duplicates by SimHash: fingerprints that differ in few bits are linked.

Every document becomes a 64-bit fingerprint. Equal fingerprints are reduced to one first, so that a
group of copies counts once, whatever its size. For the rest, the bits are cut into ``blocks``; two
fingerprints that differ in at most ``radius`` bits agree in all bits of at least ``blocks - radius``
of them, so comparing all that agree in some such choice finds every link and misses none. What
agrees is compared bit-sliced: bit planes hold one bit of 64 fingerprints in a word, carry-save
counters add up the differing planes for all of them together, and a block of words is left as soon
as every distance in it is above the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.components import Forest, components
from telemetra.sources.scans import materialise

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
BITS = 64
# The bits are cut into this many blocks, and keys take ``BLOCKS - RADIUS`` of them. More blocks make longer
# keys, which fewer fingerprints share, but more of them: 6 give 15 keys of 21 bits, 7 give 35 of 27 bits and
# 8 give 70 of 32 bits. Links are the same for all; 7 pays off above some 10^9 documents, 8 above 10^11.
BLOCKS = 6
# Fingerprints under one key are compared by tasks that hold at most about two of such pieces.
PIECE = 2048
# Groups of at most so many rows are compared together.
SMALL = 32
# Words of a bit plane that are counted and left together.
STRIP = 64
FULL = np.uint64(2**64 - 1)


def _fingerprint(text: str | None, width: int) -> int:
    """Majority of each bit over the hashes of all shingles, as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for begin in range(0, n, 65536):
        spans = zip(starts[begin : min(n, begin + 65536)].tolist(), last[begin : begin + 65536].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * counts > n).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (doc_id, fp): the id and the fingerprint as a signed number; null texts count as empty."""

    @F.pandas_udf("long")
    def fingerprint(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(text, width) for text in texts], dtype="int64")

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), fingerprint(F.col(text_column)).alias("fp"))


def hexadecimal(fp: Column) -> Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _masks(blocks: int, radius: int) -> list[int]:
    """A mask for each choice of blocks in which two linked fingerprints may agree."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(parts, blocks - radius)]
    return [mask - 2**64 if mask >= 2**63 else mask for mask in masks]


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes: row b has bit b of all values, 64 values in a word; the last word is filled up with zeros."""
    words = -(-len(values) // 64)
    padded = np.zeros(words * 64, dtype="<u8")
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _near(query: np.ndarray, planes: np.ndarray, radius: int, order: np.ndarray) -> np.ndarray:
    """For each query, a word of flags for each word of the planes: who is within the radius.

    Counters are bit-sliced as well: ``counter[i]`` holds bit i of all distances, ``over`` those that ran out of
    the counter. Differing planes come in pairs through one carry-save adder.
    """
    size = max(1, radius.bit_length())
    n, words = len(query), planes.shape[1]
    result = np.zeros((n, words), dtype=np.uint64)
    for left in range(0, words, STRIP):
        part = planes[:, left : left + STRIP]
        rows = np.arange(n)
        counter = np.zeros((size, n, part.shape[1]), dtype=np.uint64)
        over = np.zeros((n, part.shape[1]), dtype=np.uint64)
        for step in range(0, BITS, 2):
            x, y = (part[b][None, :] ^ (FULL * ((query[rows] >> np.uint64(b)) & np.uint64(1)))[:, None] for b in order[step : step + 2])
            half = counter[0] ^ x
            carry = (counter[0] & x) | (half & y)
            counter[0] = half ^ y
            for i in range(1, size):
                counter[i], carry = counter[i] ^ carry, counter[i] & carry
            over |= carry
            if step % 8 == 6:
                alive = ~np.all(_above(counter, over, radius) == FULL, axis=1)
                if not alive.all():
                    rows, counter, over = rows[alive], counter[:, alive], over[alive]
                    if not len(rows):
                        break
        if len(rows):
            result[rows, left : left + part.shape[1]] = ~_above(counter, over, radius)
    return result


def _above(counter: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """Flags of the distances above the radius, by a bitwise comparison from the highest bit down."""
    above, equal = over.copy(), ~over
    for i in range(len(counter) - 1, -1, -1):
        if radius >> i & 1:
            equal = equal & counter[i]
        else:
            above |= equal & counter[i]
            equal = equal & ~counter[i]
    return above


def _order(planes: np.ndarray, n: int) -> np.ndarray:
    """Planes in the order that tells fingerprints apart soonest: those with bits of both kinds first."""
    ones = np.bitwise_count(planes).sum(axis=1, dtype=np.int64)
    return np.argsort(np.abs(2 * ones - n), kind="stable")


def _flags(words: np.ndarray, n: int) -> np.ndarray:
    """The first n flags of words of 64, as booleans."""
    return np.unpackbits(words.view(np.uint8), axis=-1, bitorder="little", count=n).astype(bool)


def near_matrix(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Who of ``left`` is within the radius of whom of ``right``, as a table of booleans."""
    planes = _planes(right)
    order = _order(planes, len(right))
    parts = [_flags(_near(left[i : i + 256], planes, radius, order), len(right)) for i in range(0, len(left), 256)]
    return np.concatenate(parts)


def near_rows(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Whether a[i] and b[i] are within the radius: their difference is compared with zero, bit-sliced."""
    if not len(a):
        return np.empty(0, dtype=bool)
    planes = _planes(a ^ b)
    return _flags(_near(np.zeros(1, dtype=np.uint64), planes, radius, _order(planes, len(a))), len(a))[0]


def _groups_of(near: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Connected groups of a two-sided table, as places on either side; places without a partner are left out."""
    new_left = near.any(axis=1)
    while new_left.any():
        left, right = np.zeros(near.shape[0], dtype=bool), np.zeros(near.shape[1], dtype=bool)
        left[new_left.argmax()] = True
        front = left.copy()
        while front.any():
            reached = near[front].any(axis=0) & ~right
            right |= reached
            front = near[:, reached].any(axis=1) & ~left
            left |= front
        new_left &= ~left
        yield np.flatnonzero(left), np.flatnonzero(right)


def _block_links(fp: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray, edges: np.ndarray, radius: int) -> pd.DataFrame:
    """Links for whole groups of sorted rows, at most one for each row. ``edges`` are the places where groups begin and end.

    Small groups are compared all together, row i with row i + 1, i + 2 and so on; large ones one by one.
    """
    forest, values = Forest(), fp.view("<u8")
    sizes = np.diff(edges)
    small = (sizes <= SMALL) & (low[edges[:-1]] == high[edges[:-1]])
    group = np.repeat(np.where(small, np.arange(len(sizes)), -1 - np.arange(len(sizes))), sizes)
    for apart in range(1, int(sizes[small].max(initial=1))):
        at = np.flatnonzero((group[:-apart] == group[apart:]) & (group[:-apart] >= 0))
        at = at[near_rows(values[at], values[at + apart], radius)]
        for x, y in zip(fp[at].tolist(), fp[at + apart].tolist()):
            forest.join(x, y)
    for number in np.flatnonzero(~small):
        part = slice(edges[number], edges[number + 1])
        first, second = fp[part][own[part] == low[part]], fp[part][own[part] == high[part]]
        if len(first) and len(second):
            for left, right in _groups_of(near_matrix(first.view("<u8"), second.view("<u8"), radius)):
                members = np.concatenate((first[left], second[right]))
                smallest = int(members.min())
                for member in members.tolist():
                    forest.join(smallest, member)
    return pd.DataFrame(forest.links(), columns=["a", "b"]).astype("int64")


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, piece: int = PIECE) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints (column fp) within the radius, enough for all components.

    Rows under one key are counted first. A key with more than ``piece`` rows is cut into pieces by another hash,
    and every two of its pieces meet in a task of their own, so that no key makes a large task.
    """
    if blocks <= radius:
        raise ValueError("there must be more blocks than differing bits")
    masks = F.explode(F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(_masks(blocks, radius))]))
    keyed = distinct.select("fp", masks.alias("k")).select("fp", "k.*")
    sizes = materialise(keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-keys")
    sized = keyed.join(sizes.rows, ["mask", "key"])
    n_pieces = F.ceil(F.col("n") / piece).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(7)), n_pieces.cast("long")).cast("int")
    other = F.explode(F.sequence(F.lit(0), n_pieces - 1))
    cut = sized.select("fp", "mask", "key", own.alias("own"), other.alias("other"))
    placed = cut.select("mask", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "fp")

    keys = ["mask", "key", "low", "high"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat((rest, batch), ignore_index=True)
            starts = _starts(rows[keys])
            yield _block(rows, starts, radius)
            rest = rows.iloc[starts[-1] :]
        if rest is not None and len(rest):
            yield _block(rest, np.array([0, len(rest)]), radius)

    return placed.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(compare, "a long, b long")


def _starts(keys: pd.DataFrame) -> np.ndarray:
    """Places where groups of sorted rows begin."""
    table = keys.to_numpy()
    return np.flatnonzero(np.concatenate(([True], (table[1:] != table[:-1]).any(axis=1))))


def _block(rows: pd.DataFrame, edges: np.ndarray, radius: int) -> pd.DataFrame:
    columns = [rows[name].to_numpy() for name in ("fp", "own", "low", "high")]
    return _block_links(*columns, edges, radius)


def near_duplicates(docs: DataFrame, width: int = SHINGLE_WORDS, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """One row (doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached over links, the row's own included. Texts without
    words, null ones among them, have fingerprint zero and are linked like any other. Repeated rows come out as often
    as they come in. A row without doc_id keeps its fingerprint and takes its component's id, which is null where
    no row of the component has an id. The result reads a stored table, removed when the process ends.
    """
    rows = materialise(fingerprints(docs, width), "simhash")
    distinct = materialise(rows.rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    with components(links(distinct.rows, radius, blocks)) as reached:
        rooted = distinct.rows.join(reached.rows, distinct.rows.fp == reached.rows.node, "left")
        rooted = rooted.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
        smallest = materialise(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-roots")
        named = materialise(rooted.join(smallest.rows, "root").select("fp", "component_id"), "simhash-groups")
    smallest.discard()
    distinct.discard()
    found = rows.until_exit().join(named.until_exit(), "fp")
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")
