"""Gradient-boosted trees in numpy, for a bounded training sample.

Logistic loss, histogram splits on quantile bins, optional monotone direction
per feature. The forest is kept as flat node arrays and scored level by level
for all rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Flat node arrays; a leaf's children are the leaf itself."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        row = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[row, self.feature[node]] <= self.threshold[node]
                node = np.where(low, self.left[node], self.right[node])
            out += self.value[node]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, monotone: dict[int, int] | None = None, trees: int = 40, depth: int = 3,
        rate: float = 0.2, bins: int = 32, ridge: float = 1.0, least: int = 5) -> Forest:
    """``monotone``: +1 or -1 for features in which the margin may only rise or fall.

    A split against its direction is refused, and both children are bounded by
    the middle of their values from then on, so the whole tree is monotone."""
    monotone = monotone or {}
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)
             for j in range(x.shape[1])]
    coded = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1) if len(x) else x
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(len(y), base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        feature.append(0)
        threshold.append(np.inf)
        left.append(len(value))
        right.append(len(value))
        value.append(rate * v)
        return len(value) - 1

    def weight(g, h, low, high):
        return np.clip(-g / (h + ridge), low, high)

    def grow(rows, level, low, high) -> int:
        gsum, hsum = g[rows].sum(), h[rows].sum()
        node = leaf(float(weight(gsum, hsum, low, high)))
        if level == depth or len(rows) < 2 * least:
            return node
        top = (1e-6, None, None, None, None)
        for j, e in enumerate(edges):
            if not len(e):
                continue
            size = len(e) + 1
            gl = np.cumsum(np.bincount(coded[rows, j], g[rows], size))[:-1]
            hl = np.cumsum(np.bincount(coded[rows, j], h[rows], size))[:-1]
            nl = np.cumsum(np.bincount(coded[rows, j], minlength=size))[:-1]
            wl, wr = weight(gl, hl, low, high), weight(gsum - gl, hsum - hl, low, high)
            gain = (gl ** 2 / (hl + ridge) + (gsum - gl) ** 2 / (hsum - hl + ridge) - gsum ** 2 / (hsum + ridge))
            bad = (nl < least) | (len(rows) - nl < least)
            if j in monotone:
                bad |= monotone[j] * (wr - wl) < 0
            gain = np.where(bad, -np.inf, gain)
            k = int(np.argmax(gain))
            if gain[k] > top[0]:
                top = (gain[k], j, k, wl[k], wr[k])
        _, j, k, wl, wr = top
        if j is None:
            return node
        middle, sign = (wl + wr) / 2, monotone.get(j, 0)
        below = coded[rows, j] <= k
        feature[node], threshold[node] = j, float(edges[j][k])
        left[node] = grow(rows[below], level + 1, middle if sign < 0 else low, middle if sign > 0 else high)
        right[node] = grow(rows[~below], level + 1, middle if sign > 0 else low, middle if sign < 0 else high)
        return node

    for _ in range(trees if len(y) else 0):
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        first = len(value)
        roots.append(grow(np.arange(len(y)), 0, -np.inf, np.inf))
        part = Forest(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value),
                      np.array([first]), depth, 0.0)
        margin = margin + part.margin(x)
    return Forest(np.array(feature, dtype=np.int64), np.array(threshold, dtype=float), np.array(left, dtype=np.int64),
                  np.array(right, dtype=np.int64), np.array(value, dtype=float), np.array(roots, dtype=np.int64),
                  depth, base)
