"""Gradient-boosted trees for two classes, by histograms, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Complete trees: at inner node k of a tree, a row goes to 2k + 2 where its feature exceeds the threshold, else to 2k + 1."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(inner + 1))):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            z += leaf[at - inner]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 5, rate: float = 0.2, bins: int = 32, shrink: float = 1.0, least: float = 5.0) -> Boosted:
    """Fits logistic loss by second-order steps; each feature's candidate thresholds are so many quantiles."""
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    code = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    width = bins + 1
    flat = code + np.arange(d) * width
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    z, inner = np.full(n, start), (1 << depth) - 1
    model = Boosted(np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, dtype=np.int64)
        for k in range(inner):
            rows = np.flatnonzero(at == k)
            if len(rows) < 2 * least:
                at[rows] = 2 * k + 1
                continue
            where = flat[rows].ravel()
            sums = [np.bincount(where, np.repeat(v[rows], d), d * width).reshape(d, width).cumsum(1) for v in (g, h)]
            left_g, left_h = sums
            all_g, all_h = g[rows].sum(), h[rows].sum()
            gain = left_g**2 / (left_h + shrink) + (all_g - left_g) ** 2 / (all_h - left_h + shrink) - all_g**2 / (all_h + shrink)
            count = np.bincount(where, minlength=d * width).reshape(d, width).cumsum(1)
            gain[(count < least) | (len(rows) - count < least)] = -1
            j, b = np.unravel_index(np.argmax(gain), gain.shape)
            if gain[j, b] <= 1e-9 or b >= len(cuts[j]):
                at[rows] = 2 * k + 1
                continue
            model.feature[t, k], model.threshold[t, k] = j, cuts[j][b]
            at[rows] = 2 * k + 1 + (code[rows, j] > b)
        leaf = at - inner
        values = -np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + shrink)
        model.leaf[t] = rate * values
        z += model.leaf[t][leaf]
    return model
