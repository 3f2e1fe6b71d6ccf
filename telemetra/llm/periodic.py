"""Runs of repeated words, found online by dyadic square catching.

Words are appended one chunk after the other. For each block length s, a power of two, every completed block of s words at a
multiple of s sets up a catcher, which waits for the suffixes that begin s to 2s - 1 words after the block. An appended word
completes one suffix of s words, so it advances one comparison a level: the suffix that begins at j meets the catcher of block
j // s - 1 and, if equal, repeats it at distance q = s + j % s. Two neighbouring blocks that are repeated at one distance hold a
square of period q. A square that no stretch of shorter period covers grows to the longest stretch with its period; a stretch that
ends with the text goes on growing when more words come. Comparisons are of hashes, every square is checked word by word.

A level keeps the hashes of its last two blocks only, and the levels are as many as the logarithm of the number of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A run has at least so many words, and so many times its period.
LEAST_WORDS, LEAST_POWER = 6, 4
# Bytes of a text that are split into words at a time.
CHUNK = 1 << 18
SPACE = re.compile(rb"[\x20\x09-\x0d]")
FACTORS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
RESULT = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

Run = tuple[int, int, int]


def chunks(data: bytes, size: int = CHUNK) -> Iterator[list[bytes]]:
    """The words of a text, some at a time: what stands between spaces and the characters 9 to 13."""
    begin = 0
    while begin < len(data):
        end = begin + size
        if end < len(data):
            space = SPACE.search(data, end)
            end = space.start() if space else len(data)
        yield data[begin:end].split()
        begin = end


class Level:
    """The catchers of blocks of one length, 2 to the power ``bits``."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.first = 0
        # Hashes of the suffixes from ``first`` on.
        self.hashes = np.zeros(0, dtype=np.uint64)
        # Whether each of the last suffixes, a block length of them, met its catcher's block.
        self.hits = np.zeros(0, dtype=bool)

    def advance(self, hashes: np.ndarray) -> np.ndarray:
        """Compare new suffixes with their catchers' blocks; the places of those that complete a square."""
        size, bits = 1 << self.bits, self.bits
        old = self.first + len(self.hashes)
        self.hashes = np.concatenate([self.hashes, hashes]) if old else hashes
        begin, end = max(old, size), old + len(hashes)
        if begin >= end:
            return np.zeros(0, dtype=np.int64)
        block = (begin >> bits) - 1
        waiting = self.hashes[(block << bits) - self.first :: size].repeat(size)
        skip = begin - ((block + 1) << bits)
        hits = self.hashes[begin - self.first :] == waiting[skip : skip + end - begin]
        if len(self.hits):
            hits = np.concatenate([self.hits, hits])
        self.hits = hits[-size:]
        return end - len(hits) + size + (hits[size:] & hits[:-size]).nonzero()[0]

    def doubled(self, done: int) -> np.ndarray:
        """Hashes of suffixes of twice the length, from the place ``done`` on."""
        size, begin = 1 << self.bits, done - self.first
        left, right = self.hashes[begin : max(begin, len(self.hashes) - size)], self.hashes[begin + size :]
        mixed = left * FACTORS[0] + right * FACTORS[1]
        mixed ^= mixed >> np.uint64(29)
        return mixed

    def forget(self) -> None:
        """Drop the hashes that no later suffix is compared or joined with."""
        n = self.first + len(self.hashes)
        keep = max(self.first, ((n >> self.bits) - 1) << self.bits)
        self.hashes, self.first = self.hashes[keep - self.first :], keep


class SquareCatcher:
    """Finds the runs of a sequence of numbers that is appended part by part."""

    def __init__(self, least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER) -> None:
        self.least_words, self.least_power = least_words, least_power
        self.n = 0
        self.buffer = np.zeros(1024, dtype=np.int64)
        self.levels = [Level(0)]
        # Stretches as (start, end, period); the open ones reach the last word.
        self.closed: list[Run] = []
        self.open: list[Run] = []

    def append(self, numbers: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(numbers)
        if self.n > len(self.buffer):
            self.buffer = np.concatenate([self.buffer[:old], np.zeros(2 * self.n - old, dtype=np.int64)])
        self.buffer[old : self.n] = numbers
        grown = [(start, self._right(end - period, period) + period, period) for start, end, period in self.open]
        self.open = []
        for run in grown:
            self._keep(run)
        hashes = numbers.astype(np.uint64) * FACTORS[2]
        hashes ^= hashes >> np.uint64(32)
        for bits in range(self.n.bit_length()):
            level = self.levels[bits]
            squares = level.advance(hashes)
            if len(squares):
                self._merge(squares, bits, grown)
            if bits + 1 == len(self.levels):
                if self.n < self.least_power << bits + 1:
                    break
                self.levels.append(Level(bits + 1))
            above = self.levels[bits + 1]
            hashes = level.doubled(above.first + len(above.hashes))
            level.forget()

    def _merge(self, squares: np.ndarray, bits: int, grown: list[Run]) -> None:
        """Make stretches of the squares that lie neither in a stretch of shorter period nor in one that has just grown over them."""
        size = 1 << bits
        period = size + (squares & (size - 1))
        begin, end = squares - period - size, squares + size
        fresh = np.ones(len(squares), dtype=bool)
        shorter = sorted(run for run in self.closed + self.open if run[2] < size)
        if shorter:
            reach = np.maximum.accumulate(np.array([run[1] for run in shorter]))
            at = np.searchsorted(np.array([run[0] for run in shorter]), begin, side="right") - 1
            fresh = (at < 0) | (reach[at] < end)
        for start, stop, q in grown:
            if size <= q < 2 * size:
                fresh &= (period != q) | (begin < start) | (end > stop)
        period, begin = period[fresh], begin[fresh]
        order = np.lexsort((begin, period))
        last, done = 0, -1
        for q, i in zip(period[order].tolist(), begin[order].tolist()):
            if q == last and i + 2 * size <= done:
                continue
            words = self.buffer
            if not np.array_equal(words[i : i + 2 * size], words[i + q : i + q + 2 * size]):
                continue
            last, done = q, self._right(i + 2 * size, q)
            self._keep((self._left(i, q), done + q, q))

    def _keep(self, run: Run) -> None:
        start, end, period = run
        if end == self.n:
            self.open.append(run)
        elif self._long(run):
            self.closed.append(run)

    def _long(self, run: Run) -> bool:
        return run[1] - run[0] >= max(self.least_words, self.least_power * run[2])

    def _right(self, i: int, q: int) -> int:
        """The first place from i on whose word is not the one q words later."""
        words, step = self.buffer, 16
        while i + q < self.n:
            end = min(i + step, self.n - q)
            differ = np.flatnonzero(words[i:end] != words[i + q : end + q])
            if len(differ):
                return i + int(differ[0])
            i, step = end, 2 * step
        return i

    def _left(self, i: int, q: int) -> int:
        """The first place of the stretch before i in which each word is the one q words later."""
        words, step = self.buffer, 16
        while i > 0:
            begin = max(0, i - step)
            differ = np.flatnonzero(words[begin:i] != words[begin + q : i + q])
            if len(differ):
                return begin + int(differ[-1]) + 1
            i, step = begin, 2 * step
        return 0

    def runs(self) -> list[Run]:
        """Runs so far as (start, length, period), by start and period; each with its smallest period."""
        smallest: dict[tuple[int, int], int] = {}
        for run in self.closed + self.open:
            if self._long(run):
                smallest[run[:2]] = min(run[2], smallest.get(run[:2], run[2]))
        return sorted((start, end - start, period) for (start, end), period in smallest.items())


def collapse(text: str | None) -> tuple[int, list[Run], str]:
    """Number of words, the runs, and the words without those that a run holds after its first period, joined by one space."""
    vocabulary: dict[bytes, int] = {}
    catcher = SquareCatcher()
    for words in chunks((text or "").encode()):
        catcher.append(np.array([vocabulary.setdefault(word, len(vocabulary)) for word in words], dtype=np.int64))
    runs = catcher.runs()
    kept = catcher.buffer[: catcher.n]
    if runs:
        change = np.zeros(catcher.n + 1, dtype=np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        kept = kept[np.cumsum(change[:-1]) == 0]
    words = list(vocabulary)
    return catcher.n, runs, b" ".join([words[i] for i in kept.tolist()]).decode()


def find_runs(docs: DataFrame, text_column: str = "text", to: str = "periodic") -> DataFrame:
    """Add a struct ``to`` of n_words, runs (start, length, period; by start and period) and the collapsed text.

    A run is a stretch of words with smallest period q (words q apart are equal) that has at least six words and four periods,
    and that no neighbouring word extends. Collapsing keeps the first q words of each run. Null and empty texts have no words
    and the collapsed text ''. Rows are judged each for itself, so repeated ones give the same; every other column stays as it
    is, except one named like ``to``, which is replaced.
    """

    @F.pandas_udf(RESULT)
    def periodic(texts: pd.Series) -> pd.DataFrame:
        found = [collapse(text) for text in texts]
        runs = [[{"start": s, "length": n, "period": q} for s, n, q in row[1]] for row in found]
        return pd.DataFrame({"n_words": [row[0] for row in found], "runs": runs, "collapsed": [row[2] for row in found]})

    return docs.withColumn(to, periodic(F.col(text_column)))
