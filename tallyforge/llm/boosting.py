"""Gradient-boosted trees for two classes, on binned features."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Logistic boosting of depth-limited trees with second-order gains."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least
        self.forest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)
        share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
        self.start = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            margin += self._grow(binned, x, p - y, np.maximum(p * (1 - p), 1e-9))
        return self

    def _grow(self, binned: np.ndarray, x: np.ndarray, grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
        """Add a tree; nodes of a full binary tree, a feature below 0 stops. Returns its values for the rows."""
        nodes = (1 << (self.depth + 1)) - 1
        feature, cut, value = np.full(nodes, -1), np.zeros(nodes), np.zeros(nodes)
        at = np.zeros(len(grad), np.int64)
        for node in range(nodes):
            rows = np.flatnonzero(at == node)
            g, h = grad[rows].sum(), hess[rows].sum()
            value[node] = -self.rate * g / (h + 1)
            if 2 * node + 2 >= nodes or h < 2 * self.least:
                continue
            best, found = 1e-6, None
            for j in range(binned.shape[1]):
                size = len(self.edges[j]) + 1
                gl = np.cumsum(np.bincount(binned[rows, j], weights=grad[rows], minlength=size))[:-1]
                hl = np.cumsum(np.bincount(binned[rows, j], weights=hess[rows], minlength=size))[:-1]
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                gain[(hl < self.least) | (h - hl < self.least)] = 0
                if len(gain) and gain.max() > best:
                    best, found = gain.max(), (j, int(gain.argmax()))
            if found:
                feature[node], cut[node] = found[0], self.edges[found[0]][found[1]]
                at[rows] = np.where(x[rows, found[0]] < cut[node], 2 * node + 1, 2 * node + 2)
        self.forest.append((feature, cut, value))
        return value[at]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        margin = np.full(len(x), self.start)
        for feature, cut, value in self.forest:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                below = x[np.arange(len(x)), np.maximum(f, 0)] < cut[at]
                at = np.where(f < 0, at, np.where(below, 2 * at + 1, 2 * at + 2))
            margin += value[at]
        return 1 / (1 + np.exp(-margin))
