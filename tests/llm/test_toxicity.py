import random

import pytest
from pyspark.sql import functions as F

from telemetra.llm import toxicity
from telemetra.llm import transducers as t


def kinds(text, words=None):
    classes = toxicity.Classes(toxicity._seed_words(), frozenset())
    return [t.EVENTS[event] for _, _, event in toxicity._events(text, classes, t.grammar())]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("what an idiot", ["insult"]),
        ("you are such an idiot", ["targeted insult"]),
        ("you see. What an idiot", ["insult"]),
        ("she is not an idiot", ["negated insult"]),
        ("she is not here, what an idiot", ["insult"]),
        ("he said they were scum", ["reported insult"]),
        ("he said so. Scum", ["insult"]),
        ("I will kill you", ["threat"]),
        ("I will kill time", []),
        ("I will never hurt you", ["negated threat"]),
        ("they wrote kill them", ["reported threat"]),
        ("kill. You", []),
        ("Trash, trash!", ["insult", "insult"]),
        ("plain words", []),
        ("", []),
        (None, []),
    ],
)
def test_clauses(text, found):
    assert kinds(text) == found


def test_composition_equals_running_one_after_another():
    draw = random.Random(0)
    first, second = t._window("N", 2, {"I": "i"}), t._whole_clause("R", {"I": "J", "i": "k"})
    both = t.compose(first, second)
    for _ in range(300):
        symbols = draw.choices("OIYNRE", k=12)
        a = b = c = 0
        for symbol in symbols:
            a, between = first.step(a, symbol)
            b, want = second.step(b, between)
            c, got = both.step(c, symbol)
            assert got == want


def corpus(spark):
    draw = random.Random(1)
    plain = ["w%s" % "".join(draw.choices("abcdefgh", k=5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(1500):
        words = draw.choices(plain, k=draw.randrange(5, 60))
        bad = i % 8 == 0
        if bad:
            for _ in range(draw.randrange(2, 5)):
                words.insert(draw.randrange(len(words)), draw.choice(["zorgla", "zorglum", "zorglik", "grumbo", "moron"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    rows += [(5000, None), (5001, ""), (None, "you moron"), (5002, "moron " * 30_000), (5003, "same"), (5003, "same")]
    labels += [(5003, None), (None, 1), (9999, 1)]
    docs = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "doc_id long, text string, y string, score double")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_words_and_beginnings(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels)
    assert "zorg" in {b[:4] for b in model.beginnings} and not any(w.startswith("w") and k == "I" for w, k in model.words.items() if len(w) == 6 and w not in toxicity.SEEDS["I"])
    scored = toxicity.score(docs, model).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held_out = {r.doc_id for r in docs.filter(toxicity.fold("doc_id", 3) == 1).collect()}
    wrong = [r for r in scored if r.doc_id in held_out and r.doc_id < 1500 and (r.toxicity.score >= 0.7) != bool(truth[r.doc_id])]
    assert len(wrong) <= 2
    assert len(scored) == docs.count() and all(0 <= r.toxicity.score <= 1 for r in scored)
    by_id = {r.doc_id: r.toxicity for r in scored}
    assert by_id[5000] == by_id[5001] and by_id[5000].matches == [] and by_id[5002].score > 0.7
    first = by_id[None].matches[0]
    assert (first.start, first.end, first.kind) == (4, 9, "targeted insult")


def test_held_out_labels_teach_nothing(spark):
    docs, labels = corpus(spark)
    flipped = labels.withColumn("toxic", F.when(toxicity.fold("doc_id", 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, labels) == toxicity.fit(docs, flipped)


def test_without_labels(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs.filter("doc_id is null"), model).first().toxicity.score > 0.7
    assert toxicity.score(docs.limit(0), model).collect() == []
