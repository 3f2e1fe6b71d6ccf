import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from telemetra.llm import simhash
from telemetra.llm.components import components


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (fps[i] ^ fps[j]).bit_count() <= 4 and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    smallest = {}
    for (doc, _), g in zip(rows, group):
        if doc is not None:
            smallest[g] = min(smallest.get(g, doc), doc)
    return sorted(((d, f"{fp:016x}", smallest.get(g)) for (d, _), fp, g in zip(rows, fps, group)), key=str)


def texts():
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdeü", k=4)) for _ in range(200)]
    rows = []
    for i in range(120):
        words = draw.choices(vocabulary, k=draw.choice([1, 3, 5, 80, 400]))
        rows.append((i, " ".join(words)))
        for copy in range(draw.choice([0, 0, 2])):
            near = list(words)
            near[draw.randrange(len(near))] = "Changed "
            rows.append((1000 + 10 * i + copy, " ".join(near)))
    return rows + [(5000, None), (5001, ""), (4999, " \t\n"), (None, "alone here"), (5002, "One two"), (5002, "One two"), (None, None), (6000, "ß x" * 40000)]


def test_components_equal_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, fp int, component_id string")
    found = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == brute(rows)


def test_hot_keys_are_cut_without_losing_links(spark):
    draw = random.Random(1)
    base = draw.getrandbits(63)
    values = list({base ^ (1 << draw.randrange(63)) ^ (1 << draw.randrange(63)) for _ in range(300)} | {draw.getrandbits(63) for _ in range(300)})
    found = spark.createDataFrame([(v,) for v in values], "fp long")
    small = {tuple(r) for r in components(simhash.links(found, piece=16)).rows.collect()}
    large = {tuple(r) for r in components(simhash.links(found, piece=10**6)).rows.collect()}
    assert small == large and len(small) > 200


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    left = rng.integers(0, 2**64, 300, dtype=np.uint64)
    right = np.concatenate((left[:200] ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)), left[:50], rng.integers(0, 2**64, 4200, dtype=np.uint64)))
    for _ in range(3):
        right[:120] ^= np.uint64(1) << rng.integers(0, 64, 120, dtype=np.uint64)
    apart = np.bitwise_count(left[:, None] ^ right[None, :])
    assert (simhash.near_matrix(left, right, radius) == (apart <= radius)).all()
    pairs = rng.integers(0, 300, 5000)
    assert (simhash.near_rows(left[pairs], right[pairs], radius) == (apart[pairs, pairs] <= radius)).all()


def test_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5), (-3, -9)]
    found = {r.node: r.root for r in components(spark.createDataFrame(path, "a long, b long")).rows.collect()}
    assert found == {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 200)} | {-3: -9}


@pytest.mark.parametrize("labels", [[1, 3, 2, 4, 0], [3, 1, 4, 2, 5, 0, 7, 6], [2, 6, 0, 7, 1, 5, 3, 4], [5, 1, 6, 2, 7, 0, 4, 3]])
def test_a_node_has_one_root_whatever_the_labels(spark, labels):
    found = components(spark.createDataFrame(list(zip(labels, labels[1:])), "a long, b long")).rows.collect()
    assert sorted((r.node, r.root) for r in found) == [(node, 0) for node in range(1, len(labels))]


def test_random_trees_have_one_root(spark):
    draw = random.Random(11)
    for _ in range(4):
        labels = draw.sample(range(8), 8)
        tree = [(label, labels[draw.randrange(i)]) for i, label in enumerate(labels) if i]
        found = components(spark.createDataFrame(tree, "a long, b long")).rows.collect()
        assert sorted((r.node, r.root) for r in found) == [(node, 0) for node in range(1, 8)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.near_duplicates(docs).select(F.col("component_id").cast("long")).isEmpty()
