"""Gradient-boosted trees for small integer features, and the calibration of their scores."""

from __future__ import annotations

import numpy as np

BINS = 32  # features are 0..31


class Boosted:
    """Trees of one depth that add up to the log-odds of the label."""

    def __init__(self, feature: np.ndarray, bound: np.ndarray, value: np.ndarray, start: float):
        self.feature, self.bound, self.value, self.start = feature, bound, value, start

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 4, rate: float = 0.25, penalty: float = 2.0) -> Boosted:
        """Second-order boosting of the logistic loss, splits found on histograms. x: (rows, features), y: 0 or 1."""
        rows, of, weight = np.unique(np.column_stack([x, y]), axis=0, return_inverse=True, return_counts=True)
        x, y, n = rows[:, :-1].astype(np.int64), rows[:, -1].astype(float), x.shape[1]
        start = float(np.log((y @ weight + 1) / ((1 - y) @ weight + 1)))
        score, inner = np.full(len(y), start), 2 ** depth - 1
        feature, bound, value = np.zeros((rounds, inner), int), np.full((rounds, inner), BINS), np.zeros((rounds, inner + 1))
        flat = x + np.arange(n) * BINS
        for r in range(rounds):
            p = 1 / (1 + np.exp(-score))
            slope, bend, node = weight * (y - p), weight * p * (1 - p), np.zeros(len(y), int)
            for level in range(depth):
                first, many = 2 ** level - 1, 2 ** level
                place = (flat + (node - first)[:, None] * (n * BINS)).ravel()
                g, h = (np.bincount(place, np.repeat(v, n), many * n * BINS).reshape(many, n, BINS) for v in (slope, bend))
                g_low, h_low = g.cumsum(axis=2), h.cumsum(axis=2)
                g_all, h_all = g_low[:, :, -1:], h_low[:, :, -1:]
                gain = g_low ** 2 / (h_low + penalty) + (g_all - g_low) ** 2 / (h_all - h_low + penalty) - g_all ** 2 / (h_all + penalty)
                best = gain.reshape(many, -1).argmax(axis=1)
                split = gain.reshape(many, -1)[np.arange(many), best] > 1e-6
                feature[r, first:first + many] = np.where(split, best // BINS, 0)
                bound[r, first:first + many] = np.where(split, best % BINS, BINS)
                node = 2 * node + 1 + (x[np.arange(len(y)), feature[r, node]] > bound[r, node])
            leaf = node - inner
            g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
            value[r] = rate * g / (h + penalty)
            score += value[r, leaf]
        return cls(feature, bound, value, start)

    def scores(self, x: np.ndarray) -> np.ndarray:
        total, at, inner = np.full(len(x), self.start), np.arange(len(x)), self.feature.shape[1]
        for feature, bound, value in zip(self.feature, self.bound, self.value):
            node = np.zeros(len(x), int)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[at, feature[node]] > bound[node])
            total += value[node - inner] if len(node) else 0
        return total


class Calibration:
    """Share of positives among held-out scores, never falling as the score rises (pooled adjacent violators)."""

    def __init__(self, scores: np.ndarray, labels: np.ndarray):
        order = np.argsort(scores, kind="stable")
        pools = []  # [labels, rows, least score]
        for s, label in zip(scores[order].tolist(), labels[order].tolist()):
            if pools and pools[-1][3] == s:
                pools[-1][0] += label
                pools[-1][1] += 1
            else:
                pools.append([float(label), 1, s, s])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                label_, rows, _, most = pools.pop()
                pools[-1][0] += label_
                pools[-1][1] += rows
                pools[-1][3] = most
        self.least = np.array([p[2] for p in pools])
        self.share = np.array([p[0] / p[1] for p in pools])

    def probability(self, scores: np.ndarray) -> np.ndarray:
        if not len(self.least):
            return np.zeros(len(scores))
        return self.share[np.maximum(np.searchsorted(self.least, scores, "right") - 1, 0)]
