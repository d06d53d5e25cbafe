"""Linear models fitted with numpy on the bounded samples of the classifiers."""

from __future__ import annotations

import numpy as np


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


class BinaryRows:
    """Rows of a sparse matrix of zeros and ones times a scale for each column: ``cols``
    (int32) laid end to end, ``sizes`` per row. Eight bytes an entry."""

    def __init__(self, cols: np.ndarray, sizes: np.ndarray, scale: np.ndarray):
        self.cols, self.scale, self.n, self.dim = cols, scale, len(sizes), len(scale)
        self.rows = np.repeat(np.arange(self.n, dtype=np.int32), sizes)[np.argsort(cols, kind="stable")]
        self.row_ends, self.col_ends = np.cumsum(sizes), np.cumsum(np.bincount(cols, minlength=self.dim))

    @staticmethod
    def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
        return np.diff(total[np.concatenate(([0], ends))])

    def dot(self, w: np.ndarray) -> np.ndarray:
        return self._sums((self.scale * w).astype(np.float32)[self.cols], self.row_ends)

    def tdot(self, g: np.ndarray) -> np.ndarray:
        return self.scale * self._sums(g.astype(np.float32)[self.rows], self.col_ends)


class DenseRows:
    def __init__(self, x: np.ndarray):
        self.x, (self.n, self.dim) = x, x.shape

    def dot(self, w):
        return self.x @ w.astype(self.x.dtype)

    def tdot(self, g):
        return self.x.T @ g.astype(self.x.dtype)


def curvature(rows, rounds: int = 12) -> float:
    """Largest eigenvalue of X'X by power iteration."""
    v = np.ones(rows.dim) / np.sqrt(max(rows.dim, 1))
    top = 1.0
    for _ in range(rounds):
        u = np.asarray(rows.tdot(rows.dot(v)), dtype=float)
        top = float(np.linalg.norm(u)) or 1.0
        v = u / top
    return top


def descend(rows, gradient, l2: float, steps: int, smooth: float, bias: float = 0.0):
    """Accelerated gradient descent on ``loss(Xw + b) + l2/2 |w|^2``.

    ``gradient(z)`` gives d loss / d z per row; ``smooth`` bounds its slope.
    """
    rate = 1.0 / (1.1 * smooth * (curvature(rows) + rows.n) + l2)
    w, b = np.zeros(rows.dim), bias
    at_w, at_b = w.copy(), b
    for k in range(1, steps + 1):
        g = gradient(np.asarray(rows.dot(at_w), dtype=float) + at_b)
        new_w = at_w - rate * (np.asarray(rows.tdot(g), dtype=float) + l2 * at_w)
        new_b = at_b - rate * float(g.sum())
        step = (k - 1) / (k + 2)
        at_w, at_b = new_w + step * (new_w - w), new_b + step * (new_b - b)
        w, b = new_w, new_b
    return w, b


def fit_logistic(rows, y: np.ndarray, l2: float, steps: int = 200, weight: np.ndarray | None = None):
    """Weighted logistic regression; returns (weights, bias)."""
    wt = np.full(rows.n, 1.0 / max(rows.n, 1)) if weight is None else weight / weight.sum()
    return descend(rows, lambda z: wt * (sigmoid(z) - y), l2, steps, 0.25 * float(wt.max()))
