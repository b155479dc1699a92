"""Gradient-boosted trees for two classes, on binned features, in numpy: small enough to fit on the driver."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic loss, second-order splits, complete trees of a fixed depth stored as arrays."""

    def __init__(self, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 48, least: float = 4.0, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least, self.ridge = trees, depth, rate, bins, least, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, m = x.shape
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(m)]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)
        mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.base = float(np.log(mean / (1 - mean)))
        score = np.full(n, self.base)
        inner = 2**self.depth - 1
        self.feature, self.cut, self.leaf = [], [], []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
            at = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, width = 2**level - 1, 2**level
                best = np.full(width, 1e-6)
                for j in range(m):
                    if not self.edges[j].size:
                        continue
                    k = self.edges[j].size + 1
                    slot = (at - first) * k + binned[:, j]
                    gs = np.bincount(slot, g, width * k).reshape(width, k).cumsum(1)
                    hs = np.bincount(slot, h, width * k).reshape(width, k).cumsum(1)
                    gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                    gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                    gain[(hl < self.least / 4) | (ht - hl < self.least / 4)] = 0
                    b = gain.argmax(1)
                    won = gain[np.arange(width), b] > best
                    best[won] = gain[np.arange(width), b][won]
                    feature[first : first + width][won] = j
                    cut[first : first + width][won] = self.edges[j][b[won]]
                at = 2 * at + 1 + (x[np.arange(n), feature[at]] > cut[at])
            at -= inner
            gs, hs = np.bincount(at, g, inner + 1), np.bincount(at, h, inner + 1)
            leaf = self.rate * gs / (hs + self.ridge)
            score += leaf[at]
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(leaf)
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            score += leaf[at - len(feature)]
        return score
