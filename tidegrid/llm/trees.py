"""Gradient-boosted trees over histograms, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Trees of one depth as arrays: a node's children are at ``2 i + 1`` and ``2 i + 2``, leaves come after all nodes.

    ``feature`` and ``limit`` are trees x nodes, ``value`` trees x leaves. A row goes right
    where its feature is above the limit; a node without a split has an endless limit.
    """

    base: float
    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Sum over trees of each row's leaf; all rows step down one level at a time."""
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        nodes = self.feature.shape[1]
        depth = (nodes + 1).bit_length() - 1
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            out += value[at - nodes]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -60, 60)))


def edges_of(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Limits between the bins of each feature: quantiles, or all values but the largest where they are few."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.arange(1, bins + 1) / bins, method="lower"))
        out.append(values[:-1])
    return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 80, depth: int = 5, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, least: float = 1e-3) -> Trees:
    """Trees for the log odds of ``y`` (0 or 1); rows count ``weight`` times.

    Each level of a tree sums first and second derivatives of the loss in bins of every
    node and feature, and splits a node where the loss falls most, by ``least`` at the least.
    """
    nodes, n, width = 2**depth - 1, len(x), x.shape[1]
    total, ones = weight.sum(), (weight * y).sum()
    base = float(np.log((ones + 0.5) / (total - ones + 0.5)))
    shape = (0 if n == 0 or ones in (0, total) else trees, nodes)
    feature, limit, value = np.zeros(shape, np.int64), np.full(shape, np.inf), np.zeros((shape[0], nodes + 1))
    edges = edges_of(x, bins) if n else []
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1) if n else np.zeros((0, width), np.int64)
    out = np.full(n, base)
    for t in range(shape[0]):
        p = 1 / (1 + np.exp(-out))
        g, h = weight * (p - y), weight * p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            key = (at - first) * (bins + 1)
            best = np.full(many, least)
            for f in range(width):
                sums = [np.bincount(key + binned[:, f], d, many * (bins + 1)).reshape(many, bins + 1) for d in (g, h)]
                left = [s.cumsum(axis=1)[:, :-1] for s in sums]
                whole = [s.sum(axis=1, keepdims=True) for s in sums]
                gain = sum(a * a / (b + ridge) for a, b in (left, (whole[0] - left[0], whole[1] - left[1]))) - whole[0] ** 2 / (whole[1] + ridge)
                gain[:, len(edges[f]) :] = -1
                cut = gain.argmax(axis=1)
                better = np.flatnonzero(gain[np.arange(many), cut] > best)
                best[better] = gain[better, cut[better]]
                feature[t, first + better], limit[t, first + better] = f, edges[f][cut[better]] if len(better) else 0
            at = 2 * at + 1 + (x[np.arange(n), feature[t][at]] > limit[t][at])
        if not np.isfinite(limit[t]).any():  # nothing is left to learn
            return Trees(base, feature[:t], limit[:t], value[:t])
        leaf = at - nodes
        value[t] = -rate * np.bincount(leaf, g, nodes + 1) / (np.bincount(leaf, h, nodes + 1) + ridge)
        out += value[t][leaf]
    return Trees(base, feature, limit, value)
