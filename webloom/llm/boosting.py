"""Gradient-boosted trees for a binary label, on binned features."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Trees as arrays: feature, threshold and value of each node of a full binary tree."""

    def __init__(self, base: float, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], depth: int):
        self.base, self.trees, self.depth = base, trees, depth

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            out += value[at]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 4, rate: float = 0.3, least: float = 5.0,
        ridge: float = 2.0) -> Boosted:
    """Newton boosting of the logistic loss; deterministic."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    n, width = binned.shape
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    f, out = np.full(n, base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        size = 2 ** (depth + 1) - 1
        feature, threshold, value = np.zeros(size, int), np.full(size, np.inf, np.float32), np.zeros(size)
        cut = np.full(size, BINS + 1)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            local = at - first
            best = np.full(count, 1e-9)
            for j in range(width):
                key = local * (BINS + 1) + binned[:, j]
                gs = np.bincount(key, g, count * (BINS + 1)).reshape(count, -1).cumsum(axis=1)
                hs = np.bincount(key, h, count * (BINS + 1)).reshape(count, -1).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt ** 2 / (ht + ridge)
                gain[(hs < least) | (ht - hs < least)] = 0
                gain = gain[:, :len(edges[j])]
                if not gain.shape[1]:
                    continue
                c = gain.argmax(axis=1)
                for k in np.flatnonzero(gain[np.arange(count), c] > best):
                    best[k] = gain[k, c[k]]
                    feature[first + k], cut[first + k], threshold[first + k] = j, c[k], edges[j][c[k]]
            at = 2 * at + 1 + (binned[np.arange(n), feature[at]] > cut[at])
        first = 2 ** depth - 1
        gs, hs = np.bincount(at - first, g, first + 1), np.bincount(at - first, h, first + 1)
        value[first:] = rate * gs / (hs + ridge)
        f += value[at]
        out.append((feature, threshold, value))
    return Boosted(base, out, depth)
