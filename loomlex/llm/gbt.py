"""Gradient-boosted trees for two classes over dense features, by histograms, and isotonic calibration; both in NumPy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth. feature, cut: trees x inner nodes; value: trees x leaves."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds. A NaN goes left."""
        out = np.full(len(x), self.base)
        rows, depth = np.arange(len(x)), int(np.log2(self.value.shape[1]))
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - (self.value.shape[1] - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, l2: float = 1.0, min_weight: float = 1.0, rows: float = 1.0, columns: float = 1.0, seed: int = 0) -> Trees:
    """Minimises log-loss. Each tree sees a share of the rows and of the columns, drawn by the seed. Without rows, or with one class only, the trees say what the smoothed base rate says."""
    n, width = x.shape
    y = y.astype(np.float64)
    rate_of_1 = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(rate_of_1 / (1 - rate_of_1)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature, cut, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    if not n or y.min() == y.max():
        return Trees(feature, cut, value, base)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    # A bin holds what is above its lower edge and not above its upper edge, as the trees' cuts do.
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    score, draw = np.full(n, base), np.random.default_rng(seed)
    for t in range(trees):
        some = np.arange(n) if rows >= 1 else np.flatnonzero(draw.random(n) < rows)
        wide = np.arange(width) if columns >= 1 else np.flatnonzero(draw.random(width) < columns)
        p = 1 / (1 + np.exp(-score[some]))
        g, h = p - y[some], np.maximum(p * (1 - p), 1e-9)
        bins_of = {j: binned[j] if len(some) == n else binned[j, some] for j in wide}
        at = np.zeros(len(some), np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            local = at - first
            best = np.zeros(count)
            sums = np.bincount(local, g, count), np.bincount(local, h, count)
            whole = sums[0] ** 2 / (sums[1] + l2)
            for j in wide:
                k = len(edges[j]) + 1
                if k < 2:
                    continue
                key = local * k + bins_of[j]
                gl = np.bincount(key, g, count * k).reshape(count, k).cumsum(axis=1)[:, :-1]
                hl = np.bincount(key, h, count * k).reshape(count, k).cumsum(axis=1)[:, :-1]
                gr, hr = sums[0][:, None] - gl, sums[1][:, None] - hl
                gain = gl**2 / (hl + l2) + gr**2 / (hr + l2) - whole[:, None]
                gain[(hl < min_weight) | (hr < min_weight)] = 0
                top = gain.argmax(axis=1)
                won = gain[np.arange(count), top] > best + 1e-9
                best[won] = gain[np.arange(count), top][won]
                feature[t, first : first + count][won] = j
                cut[t, first : first + count][won] = edges[j][top[won]]
            at = 2 * at + 1 + (x[some, feature[t][at]] > cut[t][at])
        leaf = at - inner
        value[t] = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        score += value[t][leaf] if len(some) == n else Trees(feature[t : t + 1], cut[t : t + 1], value[t : t + 1], 0.0).raw(x)
    return Trees(feature, cut, value, base)


@dataclass
class Isotonic:
    """A monotone step map from score to probability, linear between the blocks' centres."""

    at: np.ndarray
    to: np.ndarray

    def __call__(self, s: np.ndarray) -> np.ndarray:
        return np.interp(s, self.at, self.to) if len(self.at) else np.asarray(s, float)


def isotonic(score: np.ndarray, y: np.ndarray, prior: float = 1.0) -> Isotonic:
    """Pools adjacent violators; each block's mean is smoothed by `prior` rows of the base rate, so that none is 0 or 1."""
    if not len(score):
        return Isotonic(np.array([]), np.array([]))
    base = (y.sum() + 0.5) / (len(y) + 1)
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # weight, sum of y, sum of score
    for s, v in zip(score[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([1.0, v, s])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
            w, a, b = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + a, blocks[-1][2] + b]
    mean = [(a + prior * base) / (w + prior) for w, a, _ in blocks]
    return Isotonic(np.array([b / w for w, _, b in blocks]), np.maximum.accumulate(mean))
