"""Small gradient-boosted trees for tables that fit one process, with calibrated outputs."""

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    feature: np.ndarray  # -1 at a leaf
    cut: np.ndarray  # goes left if the value is at most this
    left: np.ndarray  # the right child is the next one
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        while True:
            f = self.feature[at]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                return self.value[at]
            node = at[inner]
            at[inner] = self.left[node] + (x[inner, f[inner]] > self.cut[node])


@dataclass
class Boosted:
    base: float
    trees: list[Tree]
    rate: float
    # calibration: outputs in ascending steps and the share of positives at each (never falling)
    steps: np.ndarray
    shares: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.rate * sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(self.steps):
            return 1 / (1 + np.exp(-self.raw(x)))
        at = np.searchsorted(self.steps, self.raw(x), side="right") - 1
        return self.shares[np.maximum(at, 0)]


def grow(x: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, depth: int, leaf: float) -> Tree:
    """Greedy splits by second-order gain."""
    feature, cut, left, value = [-1], [0.0], [0], [0.0]
    todo = [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, level = todo.pop()
        g, h = gradient[rows].sum(), hessian[rows].sum()
        value[node] = float(-g / (h + leaf))
        best = (1e-6, -1, 0.0)
        for f in range(x.shape[1]) if level < depth and len(rows) > 1 else ():
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v = x[order, f]
            gs, hs = np.cumsum(gradient[order])[:-1], np.cumsum(hessian[order])[:-1]
            gain = gs**2 / (hs + leaf) + (g - gs) ** 2 / (h - hs + leaf) - g**2 / (h + leaf)
            gain[v[1:] == v[:-1]] = -np.inf
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), f, float((v[k] + v[k + 1]) / 2))
        if best[1] >= 0:
            feature[node], cut[node], left[node] = best[1], best[2], len(feature)
            goes = x[rows, best[1]] > best[2]
            for part in (rows[~goes], rows[goes]):
                todo.append((len(feature), part, level + 1))
                feature.append(-1)
                cut.append(0.0)
                left.append(0)
                value.append(0.0)
    return Tree(np.array(feature), np.array(cut), np.array(left), np.array(value))


def isotonic(score: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps and shares of the best never-falling fit (pooling of neighbours)."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # first score, sum, count
    for s, y in zip(score[order].tolist(), label[order].tolist(), strict=True):
        if pools and pools[-1][0] == s:
            pools[-1][1] += y
            pools[-1][2] += 1
        else:
            pools.append([s, float(y), 1.0])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, y2, n2 = pools.pop()
            pools[-1][1] += y2
            pools[-1][2] += n2
    return np.array([p[0] for p in pools]), np.array([p[1] / p[2] for p in pools])


def boost(
    x: np.ndarray, y: np.ndarray, held: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, leaf: float = 1.0
) -> Boosted:
    """Logistic boosting on the rows not ``held``; the held ones calibrate. Of one class only, it is a constant."""
    train = ~held
    if not train.any():
        train = np.ones(len(x), bool)
    share = (y[train].sum() + 0.5) / (train.sum() + 1)
    base = float(np.log(share / (1 - share)))
    trees: list[Tree] = []
    at = np.full(len(x), base)
    for _ in range(rounds if 0 < y[train].sum() < train.sum() else 0):
        p = 1 / (1 + np.exp(-at[train]))
        trees.append(grow(x[train], p - y[train], p * (1 - p), depth, leaf))
        at += rate * trees[-1].predict(x)
    steps, shares = isotonic(at[held], y[held]) if held.any() else (np.zeros(0), np.zeros(0))
    return Boosted(base, trees, rate, steps, shares)
