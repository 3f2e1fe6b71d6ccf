"""Personal data and secrets in texts.

Four kinds are fixed patterns with a check (the base), and are always found. Beyond them generators with high recall
propose spans that may overlap; boosted trees rate each by its format and context, and a threshold for each kind selects which are
added. The trees learn from proposals of the corpus and from made examples, so that a small corpus has sense as well. A
proposal counts as right if a check of its kind holds, such as a checksum, a known ending or a name in front. Whether a secret has a name
is hidden from the trees: they judge by its format and by what stands directly beside it, so they add secrets whose
name no list has, and leave out named words that don't look like secrets.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetra.llm import boosting
from telemetra.sources.scans import materialise

BASE = ("email", "ip", "card", "phone")
# Kinds that the method may add, listed after the base ones.
KINDS = (*BASE, "secret", "iban", "ssn")
# Proposals that the trees are fitted on, at most, and documents they are taken from, as expected by hash.
MAX_PROPOSALS, SAMPLE_DOCS = 20_000, 20_000
# Precision that a kind's threshold must reach on proposals kept out of the fit, and the lowest threshold where nothing speaks against any.
PRECISION, LEAST_RATING = 0.97, 0.5
# Made examples of each kind and outcome, to fit on and to calibrate on.
MADE_TO_FIT, MADE_TO_CALIBRATE = 120, 40
# Ratings are counted in bins; a power of two, so that limits of bins are exact.
RATING_BINS = 2**14
CALIBRATION_FOLDS = 4
CONTEXT = 24
HEXADECIMAL = frozenset("0123456789abcdef")
SPANS = "array<struct<start:int,end:int,kind:string>>"
# The column of spans while texts are redacted.
FOUND = "_personal_data"

# The base patterns.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The same matches as without the look-behind and possessive repeats, but linear in a run of digits.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Generators: what may be personal, by kind. Words in front are part of the context, not of the span. Repeats without an
# upper length start where a run does, so that they take linear time.
GENERATORS = {
    "email": re.compile(r"(?:(?<![\w.-])[A-Za-z0-9._-]{2,}|(?<=-)[A-Za-z0-9._-]{2,40})\s?(?:\(at\)|\[at\]|\bat\b|@)\s?[A-Za-z0-9-]{2,63}\s?(?:\(dot\)|\[dot\]|\bdot\b)\s?[a-z]{2,10}\b"),
    "phone": re.compile(r"(?<![\w.])(?:\([0-9]{2,4}\)[ -]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![\w.]?[0-9])"),
    "secret": re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_-]*+[0-9]|[A-Z0-9]{16})[A-Za-z0-9+/_-]{12,}+"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
}
# A secret may also stand behind its name, whatever it looks like.
NAMED = re.compile(r"(?i)\b(?:password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?([^\s\"',;]{6,}+)")
# Words in front of each kind, endings of addresses.
NAMES = {
    kind: re.compile(rf"(?<![^\W\d_])(?:{words.replace(' ', '|')})(?![^\W\d_])", re.IGNORECASE)
    for kind, words in {
        "email": "mail email contact kontakt correo courriel",
        "phone": "tel telephone telefon téléphone teléfono phone call fax mobile mobil cell handy",
        "secret": "password passwd pwd passwort token secret key apikey",
        "iban": "iban konto account compte cuenta",
        "ssn": "ssn social",
    }.items()
}
ENDINGS = frozenset("com org net edu gov info io co de fr es it nl ch at eu uk us ca".split())
ENDING = re.compile(r"[A-Za-z]+$")
MARKED = re.compile(r"[(\[](?:at|dot)[)\]]|@")
CLOUD_KEY = re.compile(r"AKIA[0-9A-Z]{16}")
US_PHONE = re.compile(r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}")


@dataclass(frozen=True)
class Model:
    trees: boosting.Trees
    # The rating from which a kind's proposals are added.
    thresholds: dict[str, float]


def _luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around every @ the longest local part that is free, and a domain with a dot."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1)
        if start < at and domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base, by start and then kind as listed."""
    found = [(a, b, 0) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split(".")):
            found.append((*m.span(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = _digits(m.group())
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((*m.span(), 2))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            found.append((*m.span(), 3))
    found.sort(key=lambda span: (span[0], span[2]))
    return [(a, b, BASE[kind]) for a, b, kind in found]


def proposals(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) that the generators find; they may overlap each other and the base."""
    found = {(m.start(1), m.end(1), "secret") for m in NAMED.finditer(text)}
    for kind, pattern in GENERATORS.items():
        found.update((m.start(), m.end(), kind) for m in pattern.finditer(text))
    return sorted(found)


def _entropy(text: str) -> float:
    return -sum(n / len(text) * log2(n / len(text)) for n in Counter(text).values())


def _named(text: str, start: int, kind: str) -> bool:
    return NAMES[kind].search(text, max(0, start - CONTEXT), start) is not None


def _check(span: str, kind: str) -> int:
    """What the form of a span says by itself: 0, or more where it is well-formed."""
    if kind == "iban":
        plain = span.replace(" ", "")
        return int(int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1)
    if kind == "ssn":
        return int(not (span.startswith(("000", "666", "9")) or "-00-" in span or span.endswith("0000")))
    if kind == "email":
        return (ENDING.search(span).group().lower() in ENDINGS) * (1 + (MARKED.search(span) is not None))
    pattern = CLOUD_KEY if kind == "secret" else US_PHONE
    return int(pattern.fullmatch(span) is not None)


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format and context of a proposal, as the trees see it; of a secret not whether it has a name."""
    span = text[start:end]
    before, after = text[max(0, start - 3) : start].strip(" \"'"), text[end : end + 1]
    digits, upper = sum(map(str.isdigit, span)), sum(map(str.isupper, span))
    letters = sum(map(str.isalpha, span))
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(span, span[1:]))
    return [
        KINDS.index(kind), len(span), digits / len(span), upper / len(span), letters / len(span), _entropy(span),
        turns / len(span), len(set(span)), sum(not c.isalnum() for c in span), float(kind != "secret" and _named(text, start, kind)),
        float(before[-1:] in ("=", ":")) if before else 0.0, float(after in ('"', "'")), float(span.lower() == span),
        float(set(span.lower()) <= HEXADECIMAL), float(_check(span, kind)),
    ]


def strict(text: str, start: int, end: int, kind: str) -> bool:
    """The check that says whether a proposal is right, for fitting and calibrating."""
    span = text[start:end]
    well_formed = _check(span, kind)
    if kind in ("iban", "ssn"):
        return well_formed > 0
    if kind == "secret":
        return well_formed > 0 or (_named(text, start, kind) and _entropy(span) > 2.5)
    return well_formed > (kind == "email") or (well_formed > 0 or kind == "phone") and _named(text, start, kind)


def made_examples(n: int, seed: int) -> list[tuple[str, int, int, str]]:
    """Texts with a proposal in them, (text, start, end, kind), ``n`` of each kind meant to be right and ``n`` meant to be wrong."""
    draw = random.Random(seed)
    words = "alpha river market station garden window model paper summer letter".split()
    pick, any_of = draw.choice, lambda letters, k: "".join(draw.choices(letters, k=k))

    def iban(right: bool) -> str:
        body = any_of("0123456789", 18)
        check = 98 - int(body + "131400") % 97
        return f"DE{check if right else (check + 1 + draw.randrange(90)) % 97:02}{body}"

    letters, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "0123456789"
    word = lambda: pick(words)
    number = lambda k: any_of(digits, k)
    makers = {
        "email": (
            lambda: (pick(["contact ", "mail: ", ""]), f"{word()}.{word()}{pick([' (at) ', ' [at] '])}{word()}{pick([' (dot) ', ' [dot] '])}{pick(['com', 'org', 'de'])}"),
            lambda: (pick(["we ", "they ", ""]), f"{word()} at {word()} dot {word()}"),
        ),
        "phone": (
            lambda: (pick(["call ", "tel: ", "phone "]), f"{number(3)}-{number(3)}-{number(4)}") if draw.random() < 0.6 else ("", f"({number(3)}) {number(3)}-{number(4)}"),
            lambda: (pick(["rooms ", "hotel ", "parts ", ""]), f"{number(3)}{pick('-. ')}{number(3)}{pick('-. ')}{number(4)}"),
        ),
        "secret": (
            lambda: (pick(["password=", "token: ", "api_key = ", 'secret="', "access_key="]), any_of(letters + digits, draw.randrange(14, 40)) + number(1)) if draw.random() < 0.7 else ("", "AKIA" + any_of("ABCDEFGHIJKLMNOP234567", 16)),
            lambda: (pick(["the ", "model: ", "see ", ""]), pick([f"{word()}{word()}{number(1)}{word()}", f"{word()}{word()}{number(6)}", f"{word()}/{word()}/{word()}{number(2)}", f"{word()}-{word()}-{number(4)}"])),
        ),
        "iban": (lambda: (pick(["IBAN ", "account ", ""]), iban(True)), lambda: (pick(["IBAN ", "part ", ""]), iban(False))),
        "ssn": (lambda: (pick(["ssn ", "social ", ""]), f"{draw.randrange(100, 600)}-{draw.randrange(10, 99)}-{draw.randrange(1000, 9999)}"), lambda: (pick(["part ", ""]), f"{pick(['000', '666', '9' + number(2)])}-{number(2)}-{number(4)}")),
    }
    rows = []
    for kind, pair in makers.items():
        for make in pair:
            for _ in range(n):
                before, span = make()
                lead = f"{word()} {word()} {before}"
                rows.append((f"{lead}{span} {word()}", len(lead), len(lead) + len(span), kind))
    return rows


class _Spans:
    """Places that don't overlap, for asking whether another one overlaps any of them."""

    def __init__(self, spans: Iterable[tuple[int, int, str]] = ()) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end, _ in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i > 0 and self.ends[i - 1] > start

    def add(self, start: int, end: int) -> None:
        i = bisect_left(self.starts, start)
        self.starts.insert(i, start)
        self.ends.insert(i, end)


def _open(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base of a text, and the proposals that lie outside of it."""
    base = base_spans(text)
    taken = _Spans(base)
    return base, [span for span in proposals(text) if not taken.overlaps(span[0], span[1])]


def fit_trees(docs: DataFrame, max_proposals: int = MAX_PROPOSALS, sample_docs: int = SAMPLE_DOCS) -> tuple[boosting.Trees, float]:
    """Trees from proposals in about ``sample_docs`` documents, chosen by hash, and from made examples; and the share of documents chosen.

    At most ``max_proposals`` of the corpus train the trees, as many of each kind as there are or its share allows, those of the
    lowest hashes.
    """
    share = min(1.0, sample_docs / max(1, docs.count()))

    def propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (int(key), start, KINDS.index(kind), features(text, start, end, kind), int(strict(text, start, end, kind)))
                for key, text in zip(batch["key"], batch["text"])
                if text
                for start, end, kind in _open(text)[1]
            ]
            yield pd.DataFrame(rows, columns=["key", "start", "kind", "x", "y"])

    chosen = docs.select("text", _key().alias("key")).filter(_trains(share))
    found = chosen.mapInPandas(propose, "key long, start int, kind int, x array<double>, y int")
    order = [F.xxhash64("key", "start", "kind"), "key", "start"]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("kind").orderBy(*order))).filter(F.col("rank") <= max_proposals)
    rows = ranked.orderBy("rank", "kind").limit(max_proposals).select("x", "y").collect()
    made = made_examples(MADE_TO_FIT, 1)
    x = [r["x"] for r in rows] + [features(*example) for example in made]
    y = [r["y"] for r in rows] + [strict(*example) for example in made]
    return boosting.fit(np.array(x, dtype=float), np.array(y, dtype=float)), share


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def _trains(share: float) -> Column:
    """Whether a document is one that trees are fitted on; ``key`` is its hash."""
    trains = F.pmod(F.xxhash64("key"), F.lit(CALIBRATION_FOLDS)) > 0
    return trains & (F.col("key") < int(share * 2**64 - 2**63)) if share < 1 else trains


def rated(docs: DataFrame, trees: boosting.Trees, to: str) -> DataFrame:
    """Add a struct ``to``: the base, and all proposals beside it, each with its rating and whether its check holds."""

    @F.pandas_udf(f"base {SPANS}, proposals array<struct<start:int,end:int,kind:string,rating:double,right:boolean>>")
    def ratings(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            base, found, x = [], [], []
            for text in texts:
                own, open_ = _open(text or "")
                base.append([dict(zip(("start", "end", "kind"), span)) for span in own])
                found.append([dict(zip(("start", "end", "kind"), span), right=strict(text, *span)) for span in open_])
                x += [features(text, *span) for span in open_]
            values = iter(trees.probability(np.array(x)).tolist() if x else ())
            for proposal in (proposal for each in found for proposal in each):
                proposal["rating"] = next(values)
            yield pd.DataFrame({"base": base, "proposals": found})

    return docs.withColumn(to, ratings(F.col("text")))


def calibrated(proposals: DataFrame, trees: boosting.Trees) -> dict[str, float]:
    """The threshold of each kind, from rows (proposals) of documents kept out of the fit and from made examples.

    Ratings are counted by kind and bin, so what is gathered has a fixed size. The examples keep every kind's threshold defined;
    in a corpus with many proposals of a kind they hardly count.
    """
    each = proposals.select(F.explode("proposals").alias("p")).select("p.kind", F.floor(F.col("p.rating") * RATING_BINS).alias("bin"), "p.right")
    counts = each.groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n"), F.count_if("right").alias("y")).toPandas()
    made = made_examples(MADE_TO_CALIBRATE, 2)
    bins = np.floor(trees.probability(np.array([features(*example) for example in made])) * RATING_BINS)
    examples = pd.DataFrame({"kind": [example[3] for example in made], "bin": bins, "n": 1, "y": [int(strict(*example)) for example in made]})
    both = pd.concat([counts, examples]).groupby(["kind", "bin"], as_index=False).sum()
    return {kind: _threshold(both[both["kind"] == kind]) for kind in KINDS}


def fit(docs: DataFrame, max_proposals: int = MAX_PROPOSALS, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Trees from a bounded sample, and thresholds from the proposals of all documents kept out of it."""
    trees, share = fit_trees(docs, max_proposals, sample_docs)
    keyed = docs.select("text", _key().alias("key")).filter(~_trains(share))
    return Model(trees, calibrated(rated(keyed, trees, "found").select("found.proposals"), trees))


def _threshold(counts: pd.DataFrame) -> float:
    """The lowest rating above which the share of right ones is as wanted, of counts by bin of rating; above all ratings if none is."""
    counts = counts[counts["bin"] >= LEAST_RATING * RATING_BINS].sort_values("bin", ascending=False)
    right, n = counts["y"].cumsum().to_numpy(), counts["n"].cumsum().to_numpy()
    good = np.flatnonzero(right >= PRECISION * n)
    return float(counts["bin"].iloc[good[-1]] / RATING_BINS) if len(good) and right[good[-1]] else 2.0


def _widest(rated: list[tuple[tuple[int, int, str], float]]) -> list[tuple[tuple[int, int, str], float]]:
    """Those that don't lie inside another of their kind, so that no part stands for the whole."""
    kept, reached = [], dict.fromkeys(KINDS, 0)
    for span, rating in sorted(rated, key=lambda pair: (pair[0][0], -pair[0][1])):
        if span[1] > reached[span[2]]:
            reached[span[2]] = span[1]
            kept.append((span, rating))
    return kept


def selected(base: list[tuple[int, int, str]], open_: list[tuple[tuple[int, int, str], float]], thresholds: dict[str, float]) -> list[tuple[int, int, str]]:
    """The base, and proposals whose rating reaches their kind's threshold, the highest rated first where they overlap."""
    good = _widest([(span, rating) for span, rating in open_ if rating >= thresholds[span[2]]])
    taken, spans = _Spans(base), list(base)
    for span, _ in sorted(good, key=lambda pair: (-pair[1], pair[0])):
        if not taken.overlaps(span[0], span[1]):
            taken.add(span[0], span[1])
            spans.append(span)
    return sorted(spans, key=lambda span: (span[0], KINDS.index(span[2])))


def all_spans(text: str | None, model: Model) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base, and the base with what the method adds, both by start and kind."""
    if not text:
        return [], []
    base, open_ = _open(text)
    if not open_:
        return base, base
    ratings = model.trees.probability(np.array([features(text, *span) for span in open_])).tolist()
    return base, selected(base, list(zip(open_, ratings)), model.thresholds)


def find(docs: DataFrame, model: Model, text_column: str = "text", to: str = "pii") -> DataFrame:
    """Add a struct ``to`` of base and spans: arrays of (start, end, kind) in code points, end exclusive, by start and kind.

    Null and empty texts have none. Every other column stays as it is, except one named like ``to``, which is replaced.
    """

    @F.pandas_udf(f"base {SPANS}, spans {SPANS}")
    def pii(texts: pd.Series) -> pd.DataFrame:
        rows = [all_spans(text, model) for text in texts]
        named = [[[dict(zip(("start", "end", "kind"), s)) for s in part] for part in row] for row in rows]
        return pd.DataFrame(named, columns=["base", "spans"])

    return docs.withColumn(to, pii(F.col(text_column)))


def fit_and_find(docs: DataFrame, to: str = "pii", max_proposals: int = MAX_PROPOSALS, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The same as ``find(docs, fit(docs))``, but every text is rated only once.

    ``docs`` has doc_id and text. Proposals are stored with their ratings, thresholds are counted from these, and what reaches
    them is selected from the stored rows.
    """
    hidden = f"_{to}_rated"
    stored, thresholds = _rated_once(docs, hidden, max_proposals, sample_docs)

    @F.pandas_udf(SPANS)
    def spans(base: pd.Series, found: pd.Series) -> pd.Series:
        rows = [[dict(zip(("start", "end", "kind"), s)) for s in _chosen(own, open_, thresholds)] for own, open_ in zip(base, found)]
        return pd.Series(rows, dtype=object)

    base, found = F.col(f"{hidden}.base"), F.col(f"{hidden}.proposals")
    chosen = F.when(F.size(found) > 0, spans(base, found)).otherwise(base)
    return stored.withColumn(to, F.struct(base.alias("base"), chosen.alias("spans"))).drop(hidden)


def _rated_once(docs: DataFrame, hidden: str, max_proposals: int, sample_docs: int) -> tuple[DataFrame, dict[str, float]]:
    """The stored rows with ``hidden``, their base and rated proposals, and the thresholds counted from these."""
    trees, share = fit_trees(docs, max_proposals, sample_docs)
    key = f"{hidden}_key"
    stored = materialise(rated(docs, trees, hidden).withColumn(key, _key()), "pii-rated").until_exit()
    apart = stored.select(f"{hidden}.proposals", F.col(key).alias("key")).filter(~_trains(share))
    return stored.drop(key), calibrated(apart, trees)


def redact(docs: DataFrame, model: Model | None = None, text_column: str = "text") -> DataFrame:
    """The same rows and columns, with the kind in brackets in place of every span; null texts stay null.

    Without a model one is fitted on these documents (doc_id and text), whose texts are rated once. Spans are chosen and
    replaced in one call, so that a task needs one Python process, and only texts with something to choose are handed to it.
    """
    if model is not None:

        @F.pandas_udf("string")
        def found_and_redacted(texts: pd.Series) -> pd.Series:
            return pd.Series([None if text is None else _without(text, all_spans(text, model)[1]) for text in texts], dtype=object)

        return docs.withColumn(text_column, found_and_redacted(F.col(text_column)))
    stored, thresholds = _rated_once(docs, FOUND, MAX_PROPOSALS, SAMPLE_DOCS)

    @F.pandas_udf("string")
    def redacted(texts: pd.Series, base: pd.Series, found: pd.Series) -> pd.Series:
        rows = [None if text is None else _without(text, _chosen(own, open_, thresholds)) for text, own, open_ in zip(texts, base, found)]
        return pd.Series(rows, dtype=object)

    base, found, text = F.col(f"{FOUND}.base"), F.col(f"{FOUND}.proposals"), F.col(text_column)
    some = F.when((F.size(base) > 0) | (F.size(found) > 0), text)
    return stored.withColumn(text_column, F.coalesce(redacted(some, base, found), text)).drop(FOUND)


def _chosen(base: Iterable[dict], found: Iterable[dict], thresholds: dict[str, float]) -> list[tuple[int, int, str]]:
    """``selected`` from the structs of a stored row."""
    rated_ = [((s["start"], s["end"], s["kind"]), s["rating"]) for s in found]
    return selected([(s["start"], s["end"], s["kind"]) for s in base], rated_, thresholds)


def _without(text: str, spans: list[tuple[int, int, str]]) -> str:
    parts, done = [], 0
    for start, end, kind in spans:
        if start >= done:
            parts += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(parts) + text[done:]
