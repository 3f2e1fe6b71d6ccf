"""Cleans a corpus of documents for training: each stage is one operator of ``telemetra.llm``.

A stage takes the documents its predecessor kept and returns what it keeps, with the columns of the input, extra
ones included; the last one returns tokens. Null and empty texts are clean documents; they are near-duplicates of each
other, so one of them stays. A row without an id passes every stage, since no other row can refer to it.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.llm import bpe, decontaminate, pii, simhash, toxicity
from telemetra.sources.scans import materialise

# Rows that a stage hands to Python at a time, at most.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 500
# Words whose tokens a task remembers: fewer than by default, since executors keep what earlier stages grew to.
REMEMBERED_WORDS = 50_000
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def _in_small_batches(spark: SparkSession) -> None:
    """Hand few texts at a time to Python, since texts can be long: buffers on both sides grow to the largest batch and stay.

    This sets the session's ``spark.sql.execution.arrow.maxRecordsPerBatch`` and leaves a smaller one alone.
    """
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not rated toxic."""
    _in_small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rating = _free(docs, "toxicity")
    scored = toxicity.score(docs, model, to=rating)
    return scored.filter(F.col(f"{rating}.score") < toxicity.THRESHOLD).drop(rating)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id; of several rows with that id the first in column order."""
    _in_small_batches(spark)
    found = simhash.near_duplicates(docs.select("doc_id", "text")).filter("doc_id is not null")
    smallest = F.max(F.col("doc_id") == F.col("component_id"))
    odd = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), smallest.alias("first")).filter("n > 1 or not first")
    marks = materialise(odd, "near-duplicates")
    kept = docs.join(marks.until_exit().select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    repeated = marks.rows.filter("first").select("doc_id")
    if repeated.isEmpty():
        return kept
    first = docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return kept.unionByName(first.select("row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _in_small_batches(spark)
    items = _free(docs, "items")
    found = decontaminate.find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), to=items)
    return found.filter(F.size(items) == 0).drop(items)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind, and ``n_chars`` counted again."""
    _in_small_batches(spark)
    redacted = pii.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document."""
    _in_small_batches(spark)
    rows = docs.select("doc_id", "lang", "source", "text")
    found = bpe.encoded(rows, VOCABULARY, "n_tokens long, ids array<int>", lambda t: bpe.whole(t)[:2], remember=REMEMBERED_WORDS)
    return found.select("doc_id", "lang", "source", "tokens.*")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("bpe", tokenise),
]
# SQL can express none of the stages in full; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}").until_exit()
    return STAGES[-1][1](spark, docs, sf_dir)
