"""Gradient-boosted trees on small integer features, for models fitted to a bounded sample.

Logistic loss, depth-wise trees, one histogram bin for each feature value; a
Platt sigmoid fitted on rows kept aside calibrates the sum of the trees. A model
is plain arrays, so it can be broadcast.
"""

from __future__ import annotations

import numpy as np

BINS = 32


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, rate: float) -> tuple:
    """(feature, threshold) of each inner node and the value of each leaf, in heap order."""
    feature = np.zeros(2 ** depth - 1, np.int64)
    threshold = np.full(2 ** depth - 1, BINS)
    node = np.zeros(len(x), np.int64)
    for at in range(2 ** depth - 1):
        here = node == at
        if here.sum() >= 2:
            g, h = grad[here], hess[here]
            best, whole = 1e-6, g.sum() ** 2 / (h.sum() + 1)
            for f in range(x.shape[1]):
                gl = np.bincount(x[here, f], g, BINS).cumsum()
                hl = np.bincount(x[here, f], h, BINS).cumsum()
                gain = gl ** 2 / (hl + 1) + (gl[-1] - gl) ** 2 / (hl[-1] - hl + 1) - whole
                k = int(gain[:-1].argmax())
                if gain[k] > best:
                    best, feature[at], threshold[at] = gain[k], f, k
        node[here] = 2 * at + 1 + (x[here, feature[at]] > threshold[at])
    leaf = node - (2 ** depth - 1)
    g, h = np.bincount(leaf, grad, 2 ** depth), np.bincount(leaf, hess, 2 ** depth)
    return feature, threshold, rate * g / (h + 1)


def _raw(model: dict, x: np.ndarray) -> np.ndarray:
    total = np.full(len(x), model["base"])
    for feature, threshold, value in model["trees"]:
        node = np.zeros(len(x), np.int64)
        while len(x) and node[0] < len(feature):  # trees are complete: all rows reach the leaves together
            node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
        total += value[node - len(feature)]
    return total


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3,
        aside: np.ndarray | None = None) -> dict:
    """Model of features 0..BINS-1 and labels 0/1; rows ``aside`` (unless given, every fifth) only calibrate it."""
    aside = np.arange(len(y)) % 5 == 4 if aside is None else aside
    if len(np.unique(y[~aside])) < 2 or len(np.unique(y[aside])) < 2:
        return {"base": float(np.where(y.mean() > 0.5, 10, -10)) if len(y) else -10.0, "trees": [], "platt": (1.0, 0.0)}
    own, target = x[~aside], y[~aside].astype(float)
    rate0 = np.clip(target.mean(), 1e-4, 1 - 1e-4)
    model = {"base": float(np.log(rate0 / (1 - rate0))), "trees": [], "platt": (1.0, 0.0)}
    raw = np.full(len(own), model["base"])
    for _ in range(rounds):
        p = _sigmoid(raw)
        tree = _tree(own, target - p, p * (1 - p), depth, rate)
        model["trees"].append(tree)
        raw += _raw({"base": 0.0, "trees": [tree]}, own)
    s, t = _raw(model, x[aside]), y[aside].astype(float)
    n1, n0 = t.sum(), len(t) - t.sum()
    t = np.where(t > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))  # Platt's smoothed targets
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps with a small ridge
        p = _sigmoid(a * s + b)
        w = p * (1 - p) + 1e-9
        g = np.array([((t - p) * s).sum() - 1e-3 * (a - 1), (t - p).sum()])
        h = np.array([[(w * s * s).sum() + 1e-3, (w * s).sum()], [(w * s).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-8:
            break
    model["platt"] = (float(a), float(b))
    return model


def probability(model: dict, x: np.ndarray) -> np.ndarray:
    a, b = model["platt"]
    return _sigmoid(a * _raw(model, x) + b)


def threshold_for(model: dict, x: np.ndarray, y: np.ndarray, precision: float, aside: np.ndarray | None = None) -> float:
    """Lowest probability from which on the kept-aside rows reach ``precision``; 1.1 if none does."""
    aside = np.arange(len(y)) % 5 == 4 if aside is None else aside
    p, t = probability(model, x[aside]), y[aside]
    order = np.argsort(-p, kind="stable")
    hit = np.cumsum(t[order]) / np.arange(1, len(order) + 1)
    last = np.append(np.diff(p[order]) != 0, True) if len(order) else np.zeros(0, bool)  # only whole ties
    good = np.flatnonzero((hit >= precision) & last)
    return float(p[order][good[-1]]) if len(good) else 1.1
