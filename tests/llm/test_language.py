import math

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from telemetra.llm import language

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(word):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        for rest in all_segmentations(word[n:]):
            yield [word[:n], *rest]


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    pieces = {"▁": 1, "a": 2, "b": 3, "ab": 4, "▁a": 5, "bab": 6, "ba": 7}
    model = language.Model(["x", "y"], pieces, language._with_fixed(rng.random((9, 2))))
    words = ["▁abab", "▁b", "▁bqab", "ab", "▁abababab"]
    scores = language.word_scores(words, model)
    for word, score in zip(words, scores):
        for lang in range(2):
            total = sum(
                math.prod(model.probability[pieces.get(p, 8 if len(p) == 1 else 0), lang] for p in parts) for parts in all_segmentations(word)
            )
            assert math.isclose(score[lang], math.log(total))


def docs(spark):
    words = {"aa": "der die und nicht ist das mit ein haus", "bb": "the and not with house this that is", "cc": "le la les avec maison ne pas est une"}
    rows = [(i * 3 + k, " ".join(text.split()[(i + j) % 8] for j in range(12)), lang) for i in range(40) for k, (lang, text) in enumerate(words.items())]
    rows += [(1000, None, "aa"), (1001, "123 ...", "bb"), (1002, "", None), (None, "the house and this", None), (1003, "x" * 5000 + " the and not", "bb"), (1003, "x" * 5000 + " the and not", "bb")]
    return spark.createDataFrame([(*row, "clash") for row in rows], "doc_id long, text string, lang string, score string")


def test_languages_of_held_out_rows(spark):
    table = docs(spark)
    model = language.fit(table, PATH)
    found = language.identify(table, model).collect()
    assert len(found) == table.count()
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[r.doc_id].language.lang == r.lang for r in found if r.doc_id is not None and r.doc_id < 1000)
    assert [by_id[i].language.lang for i in (1000, 1001, 1002, None)] == ["und", "und", "und", "bb"]
    assert all(0 <= r.language.score <= 1 for r in found)
    assert model.probability[1:-1].sum(axis=0).round(9).tolist() == [1, 1, 1]


def test_held_out_rows_teach_nothing(spark):
    table = docs(spark)
    held_out = language.fold("doc_id", 4) == 2
    changed = table.withColumn("text", F.when(held_out, F.lit("zzz qqq")).otherwise(F.col("text"))).withColumn("lang", F.when(held_out, F.lit("other")).otherwise(F.col("lang")))
    a, b = language.fit(table, PATH), language.fit(changed, PATH)
    assert a.languages == b.languages and np.allclose(a.probability, b.probability)


def test_without_documents(spark):
    table = docs(spark)
    model = language.fit(table.limit(0), PATH)
    assert {r.language.lang for r in language.identify(table, model).collect()} == {"und"}
