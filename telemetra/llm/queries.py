"""Registered queries of the text operators, each over its whole table, and their SQL."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from telemetra.llm import bpe, decontaminate, language, licenses, negatives, periodic, pii, simhash, topk, toxicity, url_rules, warc, wrappers
from telemetra.session import workspace
from telemetra.sources.scans import remove_at_exit

# Host, path and verdict of the rules that the pages are judged by.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = wrappers.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts of base spans, the hash of their list, and the list of all spans."""

    def listed(column: str) -> Column:
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("pii.base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{kind}") for kind in pii.BASE]
    n_spans = F.size("pii.spans").cast("long").alias("n_spans")
    return found.select("doc_id", *counts, F.sha2(listed("pii.base"), 256).alias("base_sha256"), listed("pii.spans").alias("spans"), n_spans)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii_digest(pii.fit_and_find(docs))


def bpe_digest(docs: DataFrame, path: str) -> DataFrame:
    """Number of tokens, and hashes of their ids and decoded text, which are taken where the tokens are."""

    def digest(tokens: bpe.Tokens) -> tuple:
        return tokens.n, hashlib.sha256(tokens.ids.encode()).hexdigest(), hashlib.sha256(tokens.text.encode()).hexdigest()

    found = bpe.encoded(docs, path, "n_tokens long, ids_sha256 string, decoded_sha256 string", digest)
    return found.select("doc_id", "tokens.*")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digest(docs, public_tokenizers.path("word_bpe_49k.json"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    ids = F.col("items.item_id")
    return found.select("doc_id", ids.alias("item_ids"), F.size(ids).alias("n_items"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; a row without an id belongs to no fold."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    found = language.identify(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(language.fold("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best others of every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a row without an id belongs to no fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    score = F.col("toxicity.score")
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        F.size("toxicity.matches").alias("n_matches"),
    )


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back; the archives go when the process ends."""
    folder = workspace(spark, "archives")
    remove_at_exit(spark, folder)
    index = warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return warc.read(index, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def with_repeats(docs: DataFrame) -> DataFrame:
    """The texts that periodic runs are looked for in: of about one of ten documents, chosen by id, the end repeats itself."""

    def repeated(doc_id: str | None, text: str | None) -> str | None:
        h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
        if h % 10 or not text:
            return text
        words, g = text.encode().split(), h // 10
        if not words:
            return text
        begin = g % len(words)
        period = 1 + (len(words) - begin) // (3 + g % 8)
        return b" ".join(words[:begin] + [words[begin + i % period] for i in range(len(words) - begin)]).decode()

    @F.pandas_udf("string")
    def texts(ids: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([repeated(*row) for row in zip(ids, texts)], dtype=object)

    return docs.withColumn("text", texts(F.col("doc_id").cast("string"), F.col("text")))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document: their number, the longest one, and hashes of their list and of the collapsed text."""
    found = periodic.find_runs(with_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))
    runs = F.col("periodic.runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size(runs).cast("long").alias("n_runs"), longest.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("periodic.collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.col2"), F.col("best.length"), -F.col("best.col3")
    exponent = F.floor(1000 * length / period).cast("long")
    return rows.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def license_digest(found: DataFrame) -> DataFrame:
    """Places of the base phrases, labels, and the surest label's share; a phrase alone counts half."""
    base = F.filter("spans", lambda s: s["exact"])

    def labels(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    def starts(pick: Callable[[Column], Column]) -> Column:
        return pick(F.transform(base, lambda s: s["start"])).cast("long")

    score = F.array_max(F.transform("spans", lambda s: F.when(s["exact"], F.lit(0.5)).otherwise(s["share"])))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        starts(F.array_min).alias("first_word"),
        starts(F.array_max).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(score, F.lit(0.0)).alias("score"),
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_digest(licenses.scan(docs, licenses.default_templates(spark)))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector for each of its positives; every seventh row has the next label."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pipeline": corpus_pipeline.run,
    "op1_main_text": op1_main_text,
    "op2_pii": op2_pii,
    "op3_bpe": op3_bpe,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_top_k": op7_top_k,
    "op8_toxicity": op8_toxicity,
    "op9_url_rules": op9_url_rules,
    "op10_warc": op10_warc,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_license_scan": op12_license_scan,
    "op13_hard_negatives": op13_hard_negatives,
}
CHECKS: dict[str, str] = {
    "op9_url_rules": r"""
        WITH u AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
            FROM pages
        ), f AS (
            SELECT u.page_id, u.host, u.path, r.rule_host || r.rule_path AS rule, r.verdict,
                   row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.rule_host || r.rule_path) DESC, length(r.rule_host) DESC) AS place
            FROM u LEFT JOIN (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
                AS r(rule_host, rule_path, verdict)
                ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host)) AND starts_with(u.path, r.rule_path)
        )
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE place = 1
    """,
    "op10_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        q AS (SELECT page_id, payload, strlen(payload) AS n, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
               CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
        FROM q
    """,
    "op7_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
                   CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op12_license_scan": f"""
        WITH t AS (
            SELECT row_number() OVER () AS template, label, exact,
                   regexp_extract_all(lower(text), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM (VALUES {", ".join(f"('{label}', '{text}', true)" for label, text in licenses.PHRASES)},
                         {", ".join(f"('{label}', '{text}', false)" for label, text in licenses.NOTICES)}) AS v(label, text, exact)
        ), tp AS (
            SELECT template, label, exact, len(words) AS length, len(words) - 1 AS n_pairs, place, words[place + 1] || ' ' || words[place + 2] AS pair
            FROM t, unnest(range(len(words) - 1)) AS u(place)
        ), d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM documents
        ), hits AS (
            SELECT d.r, tp.*, i, i - place AS diagonal
            FROM d, unnest(range(len(words) - 1)) AS u(i), tp WHERE words[i + 1] || ' ' || words[i + 2] = tp.pair
        ), diagonals AS (
            SELECT r, template, exact, diagonal FROM hits GROUP BY r, template, exact, n_pairs, diagonal
            HAVING count(*) >= CASE WHEN exact THEN n_pairs ELSE least({licenses.LEAST_VOTES}, n_pairs) END
        ), steps AS (
            SELECT *, exact OR coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {licenses.GAP}, true) AS new FROM diagonals
        ), bands AS (
            SELECT r, template, diagonal, sum(new::INT) OVER (PARTITION BY r, template ORDER BY diagonal) AS band FROM steps
        ), spans AS (
            SELECT r, label, exact, min(i) AS first, count(DISTINCT place) / n_pairs AS share
            FROM hits JOIN bands USING (r, template, diagonal) GROUP BY r, template, label, exact, length, n_pairs, band
            HAVING share >= CASE WHEN exact THEN 1.0 WHEN length < {licenses.SHORT} THEN {licenses.SHORT_SHARE} ELSE {licenses.SHARE} END
        ), s AS (
            SELECT r, count(*) FILTER (exact) AS n_base, min(first) FILTER (exact) AS first_word, max(first) FILTER (exact) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
                   max(CASE WHEN exact THEN 0.5::DOUBLE ELSE share END) AS score
            FROM spans GROUP BY r
        )
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
               coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
        FROM d LEFT JOIN s USING (r)
    """,
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS anchor_id, d.vec_id, q.label = d.label AS same,
                   CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        ), n AS (
            SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
                   CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        )
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """,
}
