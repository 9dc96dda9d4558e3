"""Gradient-boosted trees on binned dense features (logistic loss) and isotonic calibration, in numpy."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Complete trees of fixed depth; a node splits on feature <= threshold."""

    def __init__(self, rounds: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 48, ridge: float = 1.0) -> None:
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(width)]
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
        most = self.bins
        rate = np.clip(np.average(y, weights=weight), 1e-6, 1 - 1e-6)
        self.start = float(np.log(rate / (1 - rate)))
        margin = np.full(n, self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = (p - y) * weight, np.maximum(p * (1 - p), 1e-9) * weight
            node = np.zeros(n, np.int64)
            inner = (1 << self.depth) - 1
            feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
            for level in range(self.depth):
                first, count = (1 << level) - 1, 1 << level
                best, choice = np.zeros(count), np.full((count, 2), -1)
                at = node - first
                for j in range(width):
                    cells = at * most + binned[:, j]
                    g = np.bincount(cells, grad, count * most).reshape(count, most)
                    h = np.bincount(cells, hess, count * most).reshape(count, most)
                    gl, hl, gs, hs = g.cumsum(1), h.cumsum(1), g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                    gain = gl**2 / (hl + self.ridge) + (gs - gl) ** 2 / (hs - hl + self.ridge) - gs**2 / (hs + self.ridge)
                    gain = gain[:, : len(cuts[j])]
                    if gain.shape[1]:
                        cut = gain.argmax(1)
                        top = gain[np.arange(count), cut]
                        better = top > best + 1e-9
                        best[better] = top[better]
                        choice[better] = np.stack([np.full(count, j), cut], axis=1)[better]
                right = np.zeros(n, bool)
                for i, (j, cut) in enumerate(choice):
                    if j >= 0:
                        feature[first + i], threshold[first + i] = j, cuts[j][cut]
                        right |= (at == i) & (binned[:, j] > cut)
                node = 2 * node + 1 + right
            leaf = node - inner
            g, h = np.bincount(leaf, grad, 1 << self.depth), np.bincount(leaf, hess, 1 << self.depth)
            value = -self.rate * g / (h + self.ridge)
            margin += value[leaf]
            self.trees.append((feature, threshold, value))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for feature, threshold, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out


class Isotonic:
    """Non-decreasing least-squares fit (pool adjacent violators), joined by straight lines."""

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Isotonic:
        xs, place = np.unique(x, return_inverse=True)
        w = np.bincount(place, weight)
        means = np.bincount(place, weight * y) / w
        blocks: list[list[float]] = []  # mean, weight, first, last
        for i, (m, v) in enumerate(zip(means, w)):
            blocks.append([m, v, i, i])
            while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
                b, a = blocks.pop(), blocks.pop()
                total = a[1] + b[1]
                blocks.append([(a[0] * a[1] + b[0] * b[1]) / total, total, a[2], b[3]])
        self.x = np.array([xs[int(b[i])] for b in blocks for i in (2, 3)])
        self.y = np.array([b[0] for b in blocks for _ in range(2)])
        return self

    def __call__(self, x: np.ndarray) -> np.ndarray:
        # A little of the margin itself keeps the order of scores inside a level step.
        return np.clip(np.interp(x, self.x, self.y) * 0.998 + 0.002 / (1 + np.exp(-np.clip(x, -30, 30))), 0.0, 1.0)
