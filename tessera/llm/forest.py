"""A small random forest: axis splits by Gini impurity on bootstrap samples."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Nodes of all trees in flat arrays; a leaf has feature -1 and its share of positives as value."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while (inner := self.feature[at] >= 0).any():
                rows = np.flatnonzero(inner)
                node = at[rows]
                less = x[rows, self.feature[node]] <= self.threshold[node]
                at[rows] = np.where(less, self.left[node], self.right[node])
            total += self.value[at]
        return total / max(len(self.roots), 1)


def _split(x: np.ndarray, y: np.ndarray, tried: np.ndarray, smallest: int) -> tuple[int, float] | None:
    best, found = 1e-12, None
    whole = len(y) * y.mean() * (1 - y.mean())
    for f in tried:
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y))
        left, right = ones[:-1], ones[-1] - ones[:-1]
        gain = whole - (left * (1 - left / n) + right * (1 - right / (len(y) - n)))
        gain[(v[1:] == v[:-1]) | (n < smallest) | (len(y) - n < smallest)] = -1
        k = int(np.argmax(gain))
        if gain[k] > best:
            best, found = gain[k], (int(f), float((v[k] + v[k + 1]) / 2))
    return found


def grow(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 8, smallest: int = 2, seed: int = 7) -> Forest:
    """Fit to features ``x`` and 0/1 labels ``y``; the same input gives the same forest."""
    rng = np.random.default_rng(seed)
    nodes: list[list] = []
    roots = []
    tries = max(1, round(np.sqrt(x.shape[1])))

    def add(rows: np.ndarray, level: int) -> int:
        me = len(nodes)
        share = float(y[rows].mean())
        nodes.append([-1, 0.0, -1, -1, share])
        if level < depth and 0 < share < 1:
            tried = rng.choice(x.shape[1], tries, replace=False)
            if cut := _split(x[rows], y[rows], tried, smallest):
                less = x[rows, cut[0]] <= cut[1]
                left, right = add(rows[less], level + 1), add(rows[~less], level + 1)
                nodes[me] = [*cut, left, right, share]
        return me

    for _ in range(trees):
        roots.append(add(rng.integers(0, len(y), len(y)), 0))
    f, t, a, b, v = zip(*nodes, strict=True)
    return Forest(np.array(f), np.array(t), np.array(a), np.array(b), np.array(v), np.array(roots))
