"""Language identification by unigram models that sum over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary, learned by expectation maximisation
on labelled texts. The probability of a word is the sum over all ways to cut it into pieces, computed by a forward
pass; a text's is the product over its words. Words are runs of letters in lower case.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.sources.scans import materialise

# Labelled documents that the models are fitted on, at most: those of the lowest hashes.
MAX_LABELLED = 8_000
ROUNDS = 3
# Share of the probability that is spread over all pieces as they occur in all languages.
SHARED = 0.02
# Probability of a letter that is no piece, in every language, and added count of a piece.
UNKNOWN, ADDED = 1e-7, 0.01
# The length in which longer runs of letters are cut, as of a script without spaces: sums over more would leave the range of doubles.
LONGEST_WORD = 48
# Words that a task remembers, words that are scored together, and characters of texts that are split together.
MAX_WORDS, TOGETHER, SLICE = 200_000, 8_192, 1_000_000
WORD = re.compile(r"[^\W\d_]+")
START = "▁"
FACTOR = np.uint64(0x9E3779B97F4A7C15)
UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    languages: list[str]
    pieces: dict[str, int]
    # A row for each piece, a column for each language; row 0 is no piece, the last row an unknown letter.
    probability: np.ndarray


def pieces_of(path: str) -> dict[str, int]:
    """Numbers, from 1, of the pieces of a sentencepiece vocabulary that can be part of a word in lower case."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    good = [name for name in names if (name == START or WORD.fullmatch(name.removeprefix(START))) and name == name.lower()]
    return {name: i for i, name in enumerate(dict.fromkeys(good), 1)}


def words_of(text: str | None) -> list[str]:
    """Words, each with a mark in front; parts of very long ones have the mark at the first part only."""
    found = [START + word for word in WORD.findall((text or "").lower())]
    if max(map(len, found), default=0) > LONGEST_WORD:
        found = [word[i : i + LONGEST_WORD] for word in found for i in range(0, len(word), LONGEST_WORD)]
    return found


class Pieces:
    """Finds pieces by a 64-bit hash of their letters, for all substrings of one length at a time."""

    def __init__(self, pieces: dict[str, int]) -> None:
        self.unknown = len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(piece) for piece in pieces}:
            same = [piece for piece in pieces if len(piece) == size]
            keys = np.zeros(len(same), dtype=np.uint64)
            for code in _codes(same).T:
                keys = keys * FACTOR + code
            order = np.argsort(keys)
            self.by_size[size] = keys[order], np.array([pieces[piece] for piece in same], dtype=np.int32)[order]

    def lattice(self, words: list[str]) -> np.ndarray:
        """Piece numbers by word, start and length less one, for words of one length; a lone letter is always some piece."""
        codes = _codes(words)
        n, length = codes.shape
        result = np.zeros((n, length, min(self.longest, length)), dtype=np.int32)
        keys = np.zeros((n, length), dtype=np.uint64)
        for size in range(1, result.shape[2] + 1):
            keys = keys[:, : length - size + 1] * FACTOR + codes[:, size - 1 :]
            found = np.zeros(keys.shape, dtype=np.int32)
            if size in self.by_size:
                known, numbers = self.by_size[size]
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                found = np.where(known[at] == keys, numbers[at], 0)
            result[:, : keys.shape[1], size - 1] = np.where((found == 0) & (size == 1), self.unknown, found)
        return result


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(words), -1).astype(np.uint64)


def _by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Places of words of the same length, some at a time."""
    lengths = np.array([len(word) for word in words])
    order = np.argsort(lengths, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        yield from (same[i : i + TOGETHER] for i in range(0, len(same), TOGETHER))


def _forward(probability: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of each beginning: by word, place and language.

    ``probability`` is that of the piece by word, start, length less one, and language.
    """
    n, length, widest, languages = probability.shape
    total = np.zeros((n, length + 1, languages))
    total[:, 0] = 1
    for end in range(1, length + 1):
        for size in range(1, min(end, widest) + 1):
            total[:, end] += total[:, end - size] * probability[:, end - size, size - 1]
    return total


def _backward(probability: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of each ending."""
    n, length, widest, languages = probability.shape
    total = np.zeros((n, length + 1, languages))
    total[:, length] = 1
    for start in range(length - 1, -1, -1):
        for size in range(1, min(length - start, widest) + 1):
            total[:, start] += total[:, start + size] * probability[:, start, size - 1]
    return total


def word_scores(words: list[str], model: Model, pieces: Pieces | None = None) -> np.ndarray:
    """Log-probability of each word in each language."""
    pieces = pieces or Pieces(model.pieces)
    scores = np.zeros((len(words), len(model.languages)))
    for same in _by_length(words) if words else ():
        lattice = pieces.lattice([words[i] for i in same])
        scores[same] = np.log(np.maximum(_forward(model.probability[lattice])[:, -1], 1e-300))
    return scores


def fold(column: str, folds: int) -> Column:
    """The fold of a row: CRC-32 of its id as text; a null id has none."""
    return F.crc32(F.col(column).cast("string")) % folds


def _labelled_words(docs: DataFrame, folds: int, held_out: int, bound: int) -> DataFrame:
    """Counts (lang, word, n) in at most ``bound`` labelled documents outside the held-out fold."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", folds) != held_out))
    key = F.xxhash64("doc_id", "lang")
    chosen = known.select("doc_id", "lang", key.alias("key")).orderBy("key", "doc_id", "lang").limit(bound).select("doc_id", "lang").distinct()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter[tuple[str, str]] = Counter()
            for lang, text in zip(batch["lang"], batch["text"]):
                seen.update((lang, word) for word in words_of(text))
            yield pd.DataFrame([(lang, word, n) for (lang, word), n in seen.items()], columns=["lang", "word", "n"])

    texts = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    # An id of many rows counts once for each language.
    texts = texts.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("lang", "text")
    return texts.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _expected(spark: SparkSession, counts: DataFrame, model: Model) -> np.ndarray:
    """Expected number of uses of each piece in each language, over all segmentations of all counted words."""
    shared = spark.sparkContext.broadcast(model)
    n_rows = len(model.probability)

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        pieces = Pieces(model.pieces)
        column = {lang: i for i, lang in enumerate(model.languages)}
        for batch in batches:
            uses = np.zeros(n_rows * len(model.languages))
            words, times = batch["word"].tolist(), batch["n"].to_numpy(dtype=float)
            langs = batch["lang"].map(column).to_numpy()
            for same in _by_length(words) if words else ():
                lattice = pieces.lattice([words[i] for i in same])
                p = model.probability[lattice, langs[same][:, None, None]][..., None]
                forward, backward = _forward(p)[..., 0], _backward(p)[..., 0]
                p = p[..., 0]
                weight = times[same] / np.maximum(forward[:, -1], 1e-300)
                for size in range(1, p.shape[2] + 1):
                    part = forward[:, : p.shape[1] - size + 1] * p[:, : p.shape[1] - size + 1, size - 1] * backward[:, size:]
                    at = lattice[:, : p.shape[1] - size + 1, size - 1] * len(model.languages) + langs[same][:, None]
                    uses += np.bincount(at.ravel(), (part * weight[:, None]).ravel(), len(uses))
            used = np.flatnonzero(uses)
            yield pd.DataFrame({"place": used, "uses": uses[used]})

    # A row for each piece and language at most, whatever the size of the corpus.
    summed = counts.mapInPandas(expect, "place long, uses double").groupBy("place").agg(F.sum("uses").alias("uses")).toPandas()
    result = np.zeros(n_rows * len(model.languages))
    result[summed["place"].to_numpy(dtype=np.int64)] = summed["uses"].to_numpy(dtype=float)
    return result.reshape(n_rows, len(model.languages))


def fit(docs: DataFrame, path: str, folds: int = 4, held_out: int = 2, bound: int = MAX_LABELLED, rounds: int = ROUNDS) -> Model:
    """Models of all languages of labelled documents outside the held-out fold.

    ``path`` is the vocabulary's file. Rows without a language, text or id teach nothing. The fit takes at most ``bound``
    documents; there is no model without any, and every text is then undetermined.
    """
    pieces = pieces_of(path)
    with materialise(_labelled_words(docs, folds, held_out, bound), "language-words") as counts:
        languages = sorted(r["lang"] for r in counts.rows.select("lang").distinct().collect())
        probability = np.full((len(pieces) + 2, len(languages)), 1 / len(pieces))
        model = Model(languages, pieces, _with_fixed(probability))
        for _ in range(rounds if languages else 0):
            uses = _expected(docs.sparkSession, counts.rows, model)[1:-1]
            own = (uses + ADDED) / (uses + ADDED).sum(axis=0)
            mixed = (1 - SHARED) * own + SHARED * own.mean(axis=1, keepdims=True)
            model = Model(languages, pieces, _with_fixed(np.pad(mixed, ((1, 1), (0, 0)))))
    return model


def _with_fixed(probability: np.ndarray) -> np.ndarray:
    """Row 0 stands for no piece, the last for an unknown letter."""
    probability[0], probability[-1] = 0, UNKNOWN
    return probability


class WordTable:
    """Scores of words, remembered up to a bound."""

    def __init__(self, model: Model) -> None:
        self.model, self.pieces = model, Pieces(model.pieces)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)))

    def learn(self, words: set[str]) -> None:
        new = sorted(word for word in words if word not in self.place)
        if len(self.place) + len(new) > MAX_WORDS:
            self.forget()
            new = sorted(words)
        self.scores = np.concatenate((self.scores, word_scores(new, self.model, self.pieces)))
        self.place.update(zip(new, range(len(self.place), len(self.scores))))

    def total(self, words: list[str]) -> np.ndarray:
        return self.scores[np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))].sum(axis=0)


def _slices(texts: pd.Series) -> Iterator[list[list[str]]]:
    """Words of texts, some texts at a time."""
    part, size = [], 0
    for text in texts:
        part.append(words_of(text))
        size += len(text or "")
        if size >= SLICE:
            yield part
            part, size = [], 0
    yield part


def identify(docs: DataFrame, model: Model, text_column: str = "text", to: str = "language") -> DataFrame:
    """Add a struct ``to`` of lang and score, the probability of the language given the text, all languages alike before.

    A null text or one without letters is undetermined, with score 0. Every other column stays as it is.
    """

    @F.pandas_udf("lang string, score double")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = WordTable(model)
        for texts in batches:
            rows = []
            for part in _slices(texts):
                table.learn({word for words in part for word in words})
                rows += [_decide(table.total(words), model) if words and model.languages else (UNDETERMINED, 0.0) for words in part]
            yield pd.DataFrame(rows, columns=["lang", "score"])

    return docs.withColumn(to, language(F.col(text_column)))


def _decide(total: np.ndarray, model: Model) -> tuple[str, float]:
    best = int(total.argmax())
    return model.languages[best], float(1 / np.exp(total - total[best]).sum())
