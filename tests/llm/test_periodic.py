import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from telemetra.llm import periodic, queries


def brute(words):
    """Every longest stretch of each period, if that is its smallest."""
    runs = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            end = i
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            part = words[i : end + q]
            if len(part) >= max(6, 4 * q) and not any(all(a == b for a, b in zip(part, part[p:])) for p in range(1, q)):
                runs.append((i, len(part), q))
            i = end + 1
    return sorted(runs)


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def caught(words, step):
    catcher = periodic.SquareCatcher()
    for i in range(0, len(words), step):
        catcher.append(np.array(words[i : i + step], dtype=np.int64))
    return catcher.runs()


pieces = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=8)


@settings(max_examples=400, deadline=None)
@given(pieces, st.sampled_from([1, 2, 3, 7, 64, 10_000]))
def test_equals_brute_force_however_words_arrive(parts, step):
    words = [word for part, times in parts for word in part * times]
    assert caught(words, step) == brute(words)


def test_longer_periods():
    draw = random.Random(3)
    for case in range(60):
        words = []
        while len(words) < 900:
            part = [draw.randrange(draw.choice([2, 5, 400])) for _ in range(draw.choice([1, 2, 3, 17, 64, 65, 120]))]
            words += (part * draw.randrange(1, 7))[: draw.randrange(1, 600)]
        assert caught(words, draw.choice([1, 50, 333, 5_000])) == brute(words), case


def test_equal_hashes_of_different_words(monkeypatch):
    monkeypatch.setattr(periodic, "FACTORS", tuple(np.uint64(x) for x in (0, 0, 0)))
    words = [1, 2, 3] * 6 + [4, 5, 4, 5, 6] + [7] * 8
    assert caught(words, 5) == brute(words)


def test_words_of_chunks():
    text = " a\tb\x0bc  d\x0c\r\ne\x1cf\x85g h i " * 50
    expected = re.findall(r"[^\x20\x09-\x0D]+", text)
    for size in (1, 7, 100, 10**6):
        assert [word.decode() for part in periodic.chunks(text.encode(), size) for word in part] == expected


@pytest.mark.parametrize("words", [["a"] * 400_000, ["a", "b"] * 200_000, (["a"] * 100 + ["b"]) * 4_000, ["a", "a", "a", "b", "c"] * 80_000], ids=len)
def test_very_long_texts_take_seconds(words):
    began = time.time()
    n, runs, kept = periodic.collapse(" ".join(words))
    assert n == len(words) and time.time() - began < 30
    whole = [run for run in runs if run[1] == n]
    assert len(whole) == 1 and kept == " ".join(words[: whole[0][2]]) or len(set(words)) > 1


def test_rows_of_a_table(spark):
    long = "x " + "to be or not " * 3_000 + "end"
    texts = [None, "", " \n ", "one", "a a a a a a", "a a a a a", "é é é é é é é", "b " * 5 + "c", long, long, "u v w " * 4 + "u"]
    docs = spark.createDataFrame([(i, text, "mine") for i, text in enumerate(texts)], "doc_id long, text string, runs string")
    rows = {r.doc_id: r for r in periodic.find_runs(docs).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        runs = [(1, 12_000, 4)] if text == long else brute(words)
        found = rows[i].periodic
        assert rows[i].runs == "mine" and found.n_words == len(words)
        assert [tuple(run) for run in found.runs] == runs and found.collapsed == collapsed(words, runs)
    assert periodic.find_runs(docs.limit(0)).collect() == []


def expected_row(doc_id, text):
    """What the query's contract says, by brute force."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=None)
    first = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    hashes = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed(words, runs))]
    return (doc_id, len(runs), *first, *hashes)


def test_query_equals_brute_force(spark, sf_small, tmp_path):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    assert docs.count() == 200
    odd = spark.createDataFrame([(None, "a " * 9), (5_000, None), (5_001, ""), (5_002, "b " * 7), (5_002, "b " * 7), (-3, "c d " * 9)], docs.schema)
    rows = [r for r in docs.collect() if r.text is None or len(r.text) < 6_000] + odd.collect()
    folder = str(tmp_path / "tables")
    spark.createDataFrame(rows, docs.schema).write.parquet(f"{folder}/documents.parquet")
    found = queries.op11_periodic_runs(spark, folder)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.columns == names
    order = lambda row: (row[0] is None, row[0] or 0, row)
    assert sorted(map(tuple, found.collect()), key=order) == sorted((expected_row(r.doc_id, r.text) for r in rows), key=order)
    assert sum(row[1] > 0 for row in map(tuple, found.collect())) > 8
