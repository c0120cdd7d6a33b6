"""Gradient-boosted trees for binary labels: logistic loss, histogram splits, trees of fixed depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    feature: np.ndarray  # trees x (2**depth - 1)
    cut: np.ndarray
    leaf: np.ndarray  # trees x 2**depth
    base: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.leaf.shape[1]))
        out = np.full(len(x), self.base, np.float32)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - (2**depth - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.25, bins: int = 32, l2: float = 2.0) -> Trees:
    """x: float32 rows x features; y: 0 or 1."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    p0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p0 / (1 - p0)))
    z = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves), np.float32)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p) + 1e-6
        at = np.zeros(n, np.int64)
        for level in range(depth):
            lo, k = 2**level - 1, 2**level
            best = np.full(k, 1e-6)
            for j in range(m):
                if not len(cuts[j]):
                    continue
                key = (at - lo) * (bins + 1) + binned[j]
                sg = np.bincount(key, g, k * (bins + 1)).reshape(k, bins + 1).cumsum(1)
                sh = np.bincount(key, h, k * (bins + 1)).reshape(k, bins + 1).cumsum(1)
                total_g, total_h = sg[:, -1:], sh[:, -1:]
                left = len(cuts[j])
                gain = sg**2 / (sh + l2) + (total_g - sg) ** 2 / (total_h - sh + l2) - total_g**2 / (total_h + l2)
                where = gain[:, :left].argmax(1)
                value = gain[np.arange(k), where]
                for i in np.flatnonzero(value > best):
                    best[i] = value[i]
                    feature[t, lo + i], cut[t, lo + i] = j, cuts[j][where[i]]
            at = 2 * at + 1 + (x[np.arange(n), feature[t][at]] > cut[t][at])
        at -= inner
        leaf[t] = rate * np.bincount(at, g, leaves) / (np.bincount(at, h, leaves) + l2)
        z += leaf[t][at]
    return Trees(feature, cut, leaf, base)
