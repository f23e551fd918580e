"""Gradient-boosted trees and isotonic calibration for small bounded samples.

The sample's feature rows fit on the driver (the callers bound them); the fitted model
is a short list of numbers that either scores numpy rows inside tasks or becomes one
SQL expression.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Tree:
    """A complete tree: node i has children 2i+1 and 2i+2; x <= threshold goes left."""

    depth: int
    feature: list[int]
    threshold: list[float]
    leaf: list[float]


@dataclass
class BoostedTrees:
    base: float
    trees: list[Tree] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in self.trees:
            node = np.zeros(len(x), np.int64)
            feature, threshold = np.array(t.feature), np.array(t.threshold)
            for _ in range(t.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += np.array(t.leaf)[node - len(feature)]
        return out

    def margin_column(self, features: list[Column]) -> Column:
        """The same sum as one expression over feature columns."""

        def walk(t: Tree, node: int) -> Column:
            inner = len(t.feature)
            if node >= inner:
                return F.lit(t.leaf[node - inner])
            left, right = walk(t, 2 * node + 1), walk(t, 2 * node + 2)
            if t.threshold[node] == float("inf"):
                return left
            return F.when(features[t.feature[node]] <= F.lit(t.threshold[node]), left).otherwise(right)

        total = F.lit(self.base)
        for t in self.trees:
            total = total + walk(t, 0)
        return total


def _bins(x: np.ndarray, most: int = 32) -> list[np.ndarray]:
    """Per feature the thresholds that may split it: midpoints at quantiles of its values."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > most:
            values = np.unique(np.quantile(column, np.linspace(0, 1, most + 1)))
        out.append((values[1:] + values[:-1]) / 2)
    return out


def fit_trees(x: np.ndarray, y: np.ndarray, n_trees: int = 40, depth: int = 3, rate: float = 0.2, min_leaf: int = 10, ridge: float = 1.0) -> BoostedTrees:
    """Logistic boosting with second-order steps; the same rows always give the same model."""
    positive = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    model = BoostedTrees(float(np.log(positive / (1 - positive))))
    if len(y) == 0 or y.min() == y.max():
        return model
    cuts = _bins(x)
    width = max(len(c) for c in cuts) + 1
    binned = np.stack([np.searchsorted(c, col, side="left") for c, col in zip(cuts, x.T)], axis=1)
    margin = np.full(len(y), model.base)
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        inner = 2**depth - 1
        feature, threshold = [0] * inner, [float("inf")] * inner
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            place = node - first
            best_gain, best = np.full(n, 1e-6), [None] * n
            for f in range(x.shape[1]):
                if not len(cuts[f]):
                    continue
                at = place * width + binned[:, f]
                sg, sh, sc = (np.bincount(at, w, n * width).reshape(n, width).cumsum(1) for w in (g, h, None))
                tg, th, tc = sg[:, -1:], sh[:, -1:], sc[:, -1:]
                gain = sg**2 / (sh + ridge) + (tg - sg) ** 2 / (th - sh + ridge) - tg**2 / (th + ridge)
                gain[(sc < min_leaf) | (tc - sc < min_leaf)] = -1
                gain = gain[:, : len(cuts[f])]
                b = gain.argmax(axis=1)
                for k in range(n):
                    if gain[k, b[k]] > best_gain[k]:
                        best_gain[k], best[k] = gain[k, b[k]], (f, int(b[k]))
            goes_right = np.zeros(len(y), bool)
            for k, choice in enumerate(best):
                if choice:
                    f, b = choice
                    feature[first + k], threshold[first + k] = f, float(cuts[f][b])
                    here = place == k
                    goes_right[here] = binned[here, f] > b
            node = 2 * node + 1 + goes_right
        at = node - inner
        sums_g, sums_h = np.bincount(at, g, 2**depth), np.bincount(at, h, 2**depth)
        leaf = rate * sums_g / (sums_h + ridge)
        model.trees.append(Tree(depth, feature, threshold, [float(v) for v in leaf]))
        margin += leaf[at]
    return model


@dataclass
class Isotonic:
    """A non-decreasing step-wise linear map from margins to probabilities."""

    x: list[float]
    y: list[float]

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.x, self.y)

    def threshold(self, probability: float) -> float:
        """The smallest margin that reaches a probability (infinity, if none does)."""
        if self.y[-1] < probability:
            return float("inf")
        k = next(i for i, v in enumerate(self.y) if v >= probability)
        if k == 0:
            return float("-inf")
        x0, x1, y0, y1 = self.x[k - 1], self.x[k], self.y[k - 1], self.y[k]
        return x0 + (x1 - x0) * (probability - y0) / (y1 - y0) if y1 > y0 else x1


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool-adjacent-violators over rows that the trees have not seen."""
    if len(margin) == 0:
        return Isotonic([0.0], [0.0])
    # rows of equal margin are one observation before anything is pooled
    values, place = np.unique(margin, return_inverse=True)
    sums, counts = np.bincount(place, y), np.bincount(place)
    blocks: list[list[float]] = []  # lowest and highest margin, sum of y, count
    for m, v, n in zip(values.tolist(), sums.tolist(), counts.tolist()):
        blocks.append([m, m, v, n])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, high, total, count = blocks.pop()
            blocks[-1][1] = high
            blocks[-1][2] += total
            blocks[-1][3] += count
    xs, ys = [], []
    for low, high, total, count in blocks:
        for m in dict.fromkeys((low, high)):
            xs.append(m)
            ys.append(total / count)
    return Isotonic(xs, ys)
