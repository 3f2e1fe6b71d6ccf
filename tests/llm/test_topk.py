import math
import random

import pytest
from pyspark.sql import functions as F

from telemetra.llm import topk


def brute(rows, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.setdefault(i, []).append([math.floor(256 * x) for x in v])
    result = []
    for q in good:
        if q % 50 == 0:
            clip = lambda s: min(max(s, -(2**63)), 2**63 - 1)
            scores = [(-max(clip(sum(a * b for a, b in zip(v, w))) for v in good[q] for w in good[i]), i) for i in good if i != q]
            result += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(result)


def search(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 1, 1) for i, v in rows], "vec_id long, embedding array<float>, score int, cell int")
    return sorted(tuple(r) for r in topk.top_k(table, F.col("vec_id") % 50 == 0, **options).collect())


def clusters(n, width, seed=1):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = [(i, [draw.gauss(c, 0.02 + 0.2 * (i % 3)) for c in draw.choice(centres)]) for i in range(n)]
    return [(i, [float(f"{x:.3f}") for x in v]) for i, v in rows]


def as_floats(rows):
    import numpy as np

    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


@pytest.mark.parametrize("options", [{}, {"n_pivots": 7, "block": 3, "piece": 20}])
def test_equals_brute_force(spark, options):
    rows = as_floats(clusters(600, 8) + [(1000 + i, [0.5] * 8) for i in range(200)])
    assert search(spark, rows, **options) == brute(rows)


def test_odd_rows(spark):
    rows = as_floats(
        [(0, [0.1, 0.2]), (50, None), (1, [0.1, None]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, []), (5, [0.3]), (100, [-1.0, 2.0, 3.0])]
        + [(6, [0.1, 0.2]), (6, [0.1, 0.2]), (7, [1.0, 1.0]), (7, [-1.0, 5.0]), (None, [1.0, 1.0]), (8, [1e30, -1e30]), (150, [1e30, 1.0]), (-50, [0.0, 0.0])]
    )
    assert search(spark, rows) == brute(rows)
    assert search(spark, rows[:0]) == [] and search(spark, [(0, [1.0])]) == []


def test_bounds_leave_groups_out():
    import numpy as np

    pivots = np.array([[100.0, 0.0], [0.0, 100.0]])
    cells = topk.Cells(pivots, np.array([10, 10]), np.array([5.0, 5.0]), np.tile(np.arange(6.0), (2, 1)))
    least, wanted = topk._needs(np.array([[50.0, 0.0]]), cells, 5)
    assert wanted[0].tolist() == [0] and least[0] < 50 * 95
