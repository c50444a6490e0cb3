"""Histogram gradient boosting for one small training frame (squared error).

The pooled forecast model is fitted once for each (series, backtest origin) on states x weeks rows, a
frame bounded by regions and calendar, not by orders. Fits are independent, so Spark spreads
them as groups (``forecast.pooled_gbm_rows``) and each runs these few numpy steps in its task.

Trees grow level by level. Numeric features are cut into at most ``MAX_BINS`` quantile bins; the
categorical one keeps a bin for each category, and at every node its categories are ordered by mean
gradient, so that the best two-way partition is one of the ordered cuts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MAX_BINS = 255        # of a numeric feature; fixed, whatever the number of categories
MIN_HESSIAN = 1e-3


def bin_edges(x: np.ndarray) -> np.ndarray:
    """Cut points of a numeric feature: between neighbouring values, or at quantiles when there are many."""
    values = np.unique(x)
    if len(values) <= MAX_BINS:
        return (values[1:] + values[:-1]) / 2
    return np.unique(np.quantile(x, np.arange(1, MAX_BINS) / MAX_BINS))


@dataclass
class Level:
    """Splits of one tree level: by node the feature (-1: none) and, by bin, whether a row goes right."""
    feature: np.ndarray
    right: np.ndarray


@dataclass
class Boosted:
    start: float
    edges: list[np.ndarray | None]          # None: a categorical feature
    trees: list[tuple[list[Level], np.ndarray]]

    def binned(self, x: np.ndarray) -> np.ndarray:
        cols = [x[:, j].astype(np.int64) if e is None else np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)]
        return np.stack(cols, axis=1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        bins, out = self.binned(x), np.full(len(x), self.start)
        for levels, leaves in self.trees:
            out += leaves[_descend(bins, levels)]
        return out


def _descend(bins: np.ndarray, levels: list[Level]) -> np.ndarray:
    node = np.zeros(len(bins), np.int64)
    rows = np.arange(len(bins))
    for level in levels:
        feature = level.feature[node]
        node = 2 * node + level.right[node, bins[rows, np.maximum(feature, 0)]]
    return node


def _best_splits(grad, count, categorical, l2, min_leaf):
    """Best split of every node from its histograms (nodes x features x bins)."""
    nodes, features, width = grad.shape
    order = np.broadcast_to(np.arange(width), grad.shape).copy()
    if categorical is not None:
        mean = np.where(count[:, categorical] > 0, grad[:, categorical] / np.maximum(count[:, categorical], 1), np.inf)
        order[:, categorical] = np.argsort(mean, axis=1, kind="stable")
        grad, count = np.take_along_axis(grad, order, 2), np.take_along_axis(count, order, 2)
    gl, nl = np.cumsum(grad, axis=2), np.cumsum(count, axis=2)
    g, n = gl[:, :, -1:], nl[:, :, -1:]
    gr, nr = g - gl, n - nl
    gain = gl ** 2 / (nl + l2) + gr ** 2 / (nr + l2) - g ** 2 / (n + l2)
    gain[(nl < max(min_leaf, MIN_HESSIAN)) | (nr < max(min_leaf, MIN_HESSIAN))] = -np.inf
    flat = gain.reshape(nodes, -1)
    at = flat.argmax(axis=1)
    feature, cut = at // width, at % width
    feature = np.where(flat[np.arange(nodes), at] > 1e-12, feature, -1)
    right = np.zeros((nodes, width), np.int64)
    for k in range(nodes):
        if feature[k] >= 0:
            right[k, order[k, feature[k], cut[k] + 1:]] = 1
    return feature, right


def fit(x: np.ndarray, y: np.ndarray, rounds: int, step: float, depth: int, min_leaf: int, l2: float,
        categorical: int | None = None) -> Boosted:
    """Boosted trees on rows ``x`` and target ``y``; ``categorical`` is the column of whole-number categories."""
    edges = [None if j == categorical else bin_edges(x[:, j]) for j in range(x.shape[1])]
    model = Boosted(float(y.mean()), edges, [])
    bins = model.binned(x)
    width = int(bins.max()) + 2
    n, features = bins.shape
    place = bins + np.arange(features) * width
    rows, fitted = np.arange(n), np.full(n, model.start)
    for _ in range(rounds):
        residual = fitted - y                       # gradient of half the squared error; the hessian is 1
        node, levels = np.zeros(n, np.int64), []
        weights = np.repeat(residual, features)
        for d in range(depth):
            nodes = 1 << d
            at = (place + (node * features * width)[:, None]).ravel()
            size = nodes * features * width
            grad = np.bincount(at, weights=weights, minlength=size).reshape(nodes, features, width)
            count = np.bincount(at, minlength=size).reshape(nodes, features, width).astype(float)
            feature, right = _best_splits(grad, count, categorical, l2, min_leaf)
            levels.append(Level(feature, right))
            of = feature[node]
            node = 2 * node + right[node, bins[rows, np.maximum(of, 0)]]
        leaves = 1 << depth
        total = np.bincount(node, weights=residual, minlength=leaves)
        held = np.bincount(node, minlength=leaves)
        value = -step * total / (held + l2)
        model.trees.append((levels, value))
        fitted += value[node]
    return model
