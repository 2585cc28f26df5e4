"""Histogram gradient-boosted trees for a binary label, as flat arrays.

Trees are complete binary trees of a fixed depth. Node ``n`` of a tree has the children ``2n+1``
and ``2n+2``; a node that is not split sends every row left. All trees are walked at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """``feature`` and ``threshold`` are (trees, inner nodes), ``value`` is (trees, leaves)."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margins(self, x: np.ndarray, rows: int = 8192) -> np.ndarray:
        """Log-odds per row."""
        out = np.full(len(x), self.base, np.float64)
        if not len(self.feature):
            return out
        trees = np.arange(len(self.feature))[None, :]
        for at in range(0, len(x), rows):
            part = x[at:at + rows]
            node = np.zeros((len(part), len(self.feature)), np.int64)
            lines = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                right = part[lines, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            out[at:at + rows] += self.value[trees, node - (2 ** self.depth - 1)].sum(axis=1)
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Bin borders per feature: midpoints between neighbouring quantiles."""
    out = []
    for j in range(x.shape[1]):
        values = np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1), method="nearest"))
        out.append(((values[1:] + values[:-1]) / 2).astype(np.float32))
    return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15,
        bins: int = 64, l2: float = 1.0, least: float = 2.0) -> Forest:
    """Fit log loss on rows ``x`` with labels ``y`` (0 or 1).

    ``least`` is the smallest sum of second derivatives of a leaf. No rows give even odds; one
    class gives its smoothed prior and no trees.
    """
    x, y = np.asarray(x, np.float32), np.asarray(y, np.float64)
    inner = 2 ** depth - 1
    prior = (y.sum() + 1.0) / (len(y) + 2.0)
    base = float(np.log(prior / (1 - prior)))
    none = Forest(base, depth, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, inner + 1)))
    if len(y) < 2 or y.min() == y.max():
        return none
    edges = _edges(x, bins)
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    width = bins + 1
    offset = np.arange(x.shape[1]) * width
    margin = np.full(len(y), base)
    feature, threshold, value = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), np.int64)
        f, t = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            cells = ((node - first)[:, None] * (x.shape[1] * width) + offset[None, :] + binned).ravel()
            size = count * x.shape[1] * width
            g = np.bincount(cells, np.repeat(grad, x.shape[1]), size).reshape(count, x.shape[1], width)
            h = np.bincount(cells, np.repeat(hess, x.shape[1]), size).reshape(count, x.shape[1], width)
            gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl ** 2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt ** 2 / (ht + l2)
            gain[(hl < least) | (ht - hl < least)] = 0
            for k in range(count):
                j, b = divmod(int(gain[k].argmax()), width)
                if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                    f[first + k], t[first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), f[node]] > t[node])
        leaf = node - inner
        gs = np.bincount(leaf, grad, inner + 1)
        hs = np.bincount(leaf, hess, inner + 1)
        v = -rate * gs / (hs + l2)
        margin += v[leaf]
        feature.append(f)
        threshold.append(t)
        value.append(v)
    return Forest(base, depth, np.array(feature), np.array(threshold), np.array(value))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit of ``y`` on ``score`` (pool adjacent violators).

    Each pooled block gives one knot at its mean score; ``np.interp`` over the knots calibrates.
    """
    if not len(score):
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of scores
    for s, v in zip(score[order], y[order]):
        blocks.append([float(v), 1.0, float(s)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return (np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks]))
