"""Toxicity by a weighted finite-state pattern grammar.

Words are classed as insult, threat, target, negation or reported speech, composed transducers find
matching clauses, and each kind of clause has a weight. Insults are partly given and partly learned:
words and word beginnings that explain labels of the training rows. Weights are fitted to the same labels,
around prior values that hold where labels say nothing.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm import transducers
from telemetra.llm.transducers import END, EVENTS, INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT
from telemetra.sources.scans import materialise

# Labelled rows that a model is fitted on, at most. They are those of the lowest hashes.
MAX_LABELLED = 30_000
THRESHOLD = 0.7
# A learned word explains labels if this much more likely than by chance (log-likelihood), and with this precision.
LEAST_EVIDENCE, LEAST_PRECISION = 18.0, 0.9
# Lengths of word beginnings that are tried beside whole words.
BEGINNINGS = range(4, 8)
RIDGE = 0.02
CACHED_WORDS = 100_000
# Documents whose words or matches are held at a time.
TOGETHER = 256

# Words of each class that the grammar starts with, in English, German, French and Spanish.
SEEDS = {
    INSULT: "idiot idiots moron morons stupid imbecile scum trash loser losers pathetic worthless disgusting clown bastard"
    " idiota imbécil estúpido estúpida basura connard crétin abruti arschloch dummkopf trottel abschaum",
    THREAT: "kill hurt destroy murder stab shoot beat töten umbringen tuer matar",
    TARGET: "you your you're u he she they them him her these those dich du euch ihr toi tu te vous usted ustedes tú ti os",
    NEGATION: "not never isn't aren't wasn't don't nicht kein keine niemals jamais nunca ningún",
    REPORT: "said says called calls quoted wrote claimed alleges reported sagte schrieb nannte cité écrit dijo llamó escribió",
}
TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:\n]+")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    words: dict[str, str]
    beginnings: frozenset[str]
    weights: tuple[float, ...]
    bias: float


class Classes(dict):
    """Class of a lower-case token; remembers what it has seen, up to a bound."""

    def __init__(self, words: dict[str, str], beginnings: frozenset[str]) -> None:
        super().__init__()
        self.words, self.beginnings = words, beginnings

    def __missing__(self, token: str) -> str:
        kind = self.words.get(token)
        if kind is None and not LETTER.match(token):
            kind = END
        if kind is None:
            kind = INSULT if any(token[:n] in self.beginnings for n in BEGINNINGS) else OTHER
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[token] = kind
        return kind


def fold(column: str, folds: int) -> Column:
    """The fold of a row: CRC-32 of its id as text; a null id has none."""
    return F.crc32(F.col(column).cast("string")) % folds


def _seed_words() -> dict[str, str]:
    return {word: kind for kind, words in SEEDS.items() for word in words.split()}


def labelled_sample(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, bound: int = MAX_LABELLED) -> DataFrame:
    """Rows (text, y) of at most ``bound`` labelled documents outside the held-out fold.

    The labels are cut to the bound first, so that they can be broadcast and texts stay where they are.
    """
    known = labels.filter(F.col("toxic").isNotNull() & (fold("doc_id", folds) != held_out)).select("doc_id", F.col("toxic").cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(bound)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # An id of many rows counts once for each label.
    return texts.groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", "y")


def _content_key(words: list[str]) -> int:
    """The same for most near copies: the smallest hash of three words in a row."""
    runs = [" ".join(three) for three in zip(words, words[1:], words[2:])] or [" ".join(words)]
    return int(pd.util.hash_array(np.array(runs, dtype=object)).view(np.int64).min())


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield from (batch.iloc[i : i + TOGETHER] for i in range(0, len(batch), TOGETHER))


def _features(words: set[str]) -> set[str]:
    return words | {word[:n] + "*" for word in words for n in BEGINNINGS if len(word) > n}


def learn_words(sample: DataFrame) -> list[str]:
    """Words, and beginnings marked by *, that explain the labels.

    Counts come from one reducing pass, in which near copies count once. Those with enough evidence must also have it
    when only different neighbours count: words that stand beside insults in copied passages keep their neighbours, and are
    left out. Of a word and its beginnings the one seen most often is taken, the longest of equals.
    """

    def per_document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _parts(batches):
            rows = []
            for text, y in zip(batch["text"], batch["y"]):
                words = WORD.findall((text or "").lower())
                rows.append((_content_key(words), int(y), list(set(words))))
            yield pd.DataFrame(rows, columns=["key", "y", "words"])

    rows = sample.mapInPandas(per_document, "key long, y int, words array<string>")
    with materialise(rows.groupBy("key", "y").agg(F.min("words").alias("words")), "toxicity-words") as stored:
        return _strong_words(sample, stored.rows)


def _strong_words(sample: DataFrame, once: DataFrame) -> list[str]:
    """The words of ``learn_words`` from rows (y, words) in which near copies count once."""

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _parts(batches):
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for y, words in zip(batch["y"], batch["words"]):
                counts[int(y > 0)].update(_features(set(words)))
            names = list(counts[0].keys() | counts[1].keys())
            yield pd.DataFrame({"feature": names, "pos": [counts[1][f] for f in names], "neg": [counts[0][f] for f in names]})

    totals = {r["y"]: r["count"] for r in once.groupBy("y").count().collect()}
    n_pos, n = sum(v for y, v in totals.items() if y > 0), sum(totals.values())
    if not 0 < n_pos < n:
        return []
    base = n_pos / n
    counted = once.mapInPandas(features, "feature string, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    all_ = F.col("pos") + F.col("neg")
    against = F.when(F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (all_ * (1 - base)))).otherwise(0.0)
    evidence = F.col("pos") * F.log(F.col("pos") / (all_ * base)) + against
    strong = counted.filter((F.col("pos") / all_ >= LEAST_PRECISION) & (evidence >= LEAST_EVIDENCE))
    # No more than one strong feature for each labelled row is looked at; these are the ones seen most often.
    names = [r["feature"] for r in strong.orderBy(F.desc("pos"), F.length("feature").desc(), "feature").limit(MAX_LABELLED).collect()]
    place = {name: i for i, name in enumerate(names)}

    def surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _parts(batches):
            found = set()
            for text, y in zip(batch["text"], batch["y"]):
                words = ["", *WORD.findall((text or "").lower()), ""] if y > 0 else []
                for before, word, after in zip(words, words[1:], words[2:]):
                    found.update((place[f], before, after) for f in _features({word}) if f in place)
            yield pd.DataFrame(sorted(found), columns=["feature", "before", "after"])

    around = sample.mapInPandas(surroundings, "feature int, before string, after string").distinct().groupBy("feature").count()
    n_around = {r["feature"]: r["count"] for r in around.collect()}
    chosen: list[str] = []
    for i, name in enumerate(names):
        seen = n_around.get(i, 0)
        if seen * log(1 / base) >= LEAST_EVIDENCE and not any(_covers(other, name) or _covers(name, other) for other in chosen):
            chosen.append(name)
    return chosen


def _covers(wide: str, narrow: str) -> bool:
    return wide.endswith("*") and narrow.startswith(wide[:-1])


def _events(text: str | None, classes: Classes, machine: transducers.Transducer) -> list[tuple[int, int, int]]:
    """(start, end, event) of every match in a text."""
    if not text or not {INSULT, THREAT} & set(map(classes.__getitem__, WORD.findall(text.lower()))):
        return []
    tokens = list(TOKEN.finditer(text))
    found = transducers.matches(machine, [classes[token.group().lower()] for token in tokens])
    return [(tokens[place].start(), tokens[place].end(), event) for place, event in found]


def _counts(events: list[tuple[int, int, int]]) -> np.ndarray:
    return np.log1p(np.bincount([event for _, _, event in events], minlength=len(EVENTS)).astype(float))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, bound: int = MAX_LABELLED) -> Model:
    """A model from labelled rows outside the held-out fold; without any, the seeds and prior weights.

    Rows without a label or id teach nothing. The fit takes at most ``bound`` rows.
    """
    with materialise(labelled_sample(docs, labels, folds, held_out, bound), "toxicity-sample") as stored:
        return _fit(stored.rows)


def _fit(sample: DataFrame) -> Model:
    learned = learn_words(sample)
    words = _seed_words() | {word: INSULT for word in learned if not word.endswith("*")}
    beginnings = frozenset(word[:-1] for word in learned if word.endswith("*"))
    machine = transducers.grammar()

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classes = Classes(words, beginnings)
        for batch in _parts(batches):
            events = [_counts(_events(text, classes, machine)) for text in batch["text"]]
            kinds = Counter((tuple(x.round(3).tolist()), int(y > 0)) for x, y in zip(events, batch["y"]))
            yield pd.DataFrame([(list(x), y, n) for (x, y), n in kinds.items()], columns=["x", "y", "n"])

    # One row for each mix of matches, at most as many as labelled rows.
    grouped = sample.mapInPandas(counts, "x array<double>, y int, n long").groupBy("x", "y").agg(F.sum("n").alias("n")).orderBy("x", "y").collect()
    prior = np.array([*transducers.PRIOR_WEIGHTS, -4.0])
    if not grouped:
        return Model(words, beginnings, tuple(prior[:-1]), float(prior[-1]))
    x = np.array([[*r["x"], 1.0] for r in grouped])
    y, n = np.array([r["y"] for r in grouped], dtype=float), np.array([r["n"] for r in grouped], dtype=float)
    weights = _logistic(x, y, n, prior)
    return Model(words, beginnings, tuple(weights[:-1].tolist()), float(weights[-1]))


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Weighted logistic regression around prior weights, by damped Newton steps."""
    weights = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (n * (p - y)) + RIDGE * n.sum() ** 0.5 * (weights - prior)
        hessian = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + RIDGE * n.sum() ** 0.5 * np.eye(len(prior))
        step = np.linalg.solve(hessian, gradient)
        weights -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return weights


def score(docs: DataFrame, model: Model, text_column: str = "text", to: str = "toxicity") -> DataFrame:
    """Add the column ``to``: a struct of score, from 0 to 1, and matches (start, end, kind; in code points).

    Null and empty texts have no matches and take the score of such texts. No other column is read, and
    any other column of the table stays as it is.
    """
    machine = transducers.grammar()

    @F.pandas_udf("score double, matches array<struct<start:int,end:int,kind:string>>")
    def toxicity(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        classes = Classes(model.words, model.beginnings)
        weights = np.array(model.weights)
        for texts in (part for batch in batches for part in (batch.iloc[i : i + TOGETHER] for i in range(0, len(batch), TOGETHER))):
            scores, found = [], []
            for text in texts:
                events = _events(text, classes, machine)
                scores.append(1 / (1 + np.exp(-np.clip(_counts(events) @ weights + model.bias, -30, 30))) if events else 1 / (1 + np.exp(-model.bias)))
                found.append([{"start": a, "end": b, "kind": EVENTS[event]} for a, b, event in events])
            yield pd.DataFrame({"score": scores, "matches": found})

    return docs.withColumn(to, toxicity(F.col(text_column)))
