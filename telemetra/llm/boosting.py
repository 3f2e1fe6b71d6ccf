"""Gradient-boosted regression trees for a yes-or-no outcome, on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROUNDS, DEPTH, RATE, BINS, LEAST_WEIGHT, RIDGE = 40, 3, 0.2, 32, 2.0, 1.0


@dataclass(frozen=True)
class Trees:
    """Complete trees: feature and limit of each inner node (level by level), value of each leaf."""

    base: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
            total += value[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _best_split(binned: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, rows: np.ndarray) -> tuple[float, int, int]:
    """(gain, feature, last bin on the left) of the best split of some rows."""
    best = (1e-9, 0, BINS)
    g, h = gradient[rows], curvature[rows]
    total_g, total_h = g.sum(), h.sum()
    for feature in range(binned.shape[1]):
        bins = binned[rows, feature]
        left_g = np.cumsum(np.bincount(bins, g, BINS + 1))
        left_h = np.cumsum(np.bincount(bins, h, BINS + 1))
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - total_g**2 / (total_h + RIDGE)
        n = np.cumsum(np.bincount(bins, minlength=BINS + 1))
        gain[(n < LEAST_WEIGHT) | (len(rows) - n < LEAST_WEIGHT)] = 0
        if gain.max() > best[0]:
            best = (float(gain.max()), feature, int(gain.argmax()))
    return best


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for rows ``x`` and outcomes ``y`` (0 or 1); the same rows always give the same trees."""
    share = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(1) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(x.shape[1])], axis=1)
    total = np.full(len(x), base)
    inner = 2**DEPTH - 1
    features, limits, values = [], [], []
    for _ in range(ROUNDS if 0 < y.sum() < len(y) else 0):
        p = 1 / (1 + np.exp(-total))
        gradient, curvature = y - p, p * (1 - p)
        feature, limit, value = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(2**DEPTH)
        members = {0: np.arange(len(x))}
        for node in range(inner):
            rows = members[node]
            _, f, last = _best_split(binned, gradient, curvature, rows) if len(rows) else (0.0, 0, BINS)
            if last < len(edges[f]):
                feature[node], limit[node] = f, edges[f][last]
            left = x[rows, feature[node]] <= limit[node]
            members[2 * node + 1], members[2 * node + 2] = rows[left], rows[~left]
        for leaf in range(2**DEPTH):
            rows = members[inner + leaf]
            value[leaf] = RATE * gradient[rows].sum() / (curvature[rows].sum() + RIDGE)
            total[rows] += value[leaf]
        features.append(feature)
        limits.append(limit)
        values.append(value)
    shape = (len(features), inner)
    return Trees(base, np.array(features, dtype=np.int64).reshape(shape), np.array(limits).reshape(shape), np.array(values).reshape(len(values), 2**DEPTH))
