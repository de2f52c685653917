"""Gradient-boosted trees for a few classes, on small dense samples, with binned features."""

from __future__ import annotations

import numpy as np


class Tree:
    """A complete binary tree of fixed depth: feature and cut of every inner node, value of every leaf."""

    def __init__(self, depth: int):
        self.depth = depth
        self.feature = np.zeros(2**depth - 1, np.int64)
        self.cut = np.full(2**depth - 1, np.inf)
        self.value = np.zeros(2**depth)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.cut[at])
        return at - (2**self.depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.leaves(x)]


def _grow(binned: np.ndarray, edges: list[np.ndarray], used: list[int], g: np.ndarray, h: np.ndarray, depth: int, least: float) -> Tree:
    tree = Tree(depth)
    n = len(binned)
    at = np.zeros(n, np.int64)
    for level in range(depth):
        first = 2**level - 1
        n_bins = max(len(e) for e in edges) + 1
        width = 2**level
        best_gain, best_f, best_b = np.full(width, 1e-9), np.zeros(width, int), np.full(width, -1)
        for f in used:
            cell = (at - first) * n_bins + binned[:, f]
            sums = [np.cumsum(np.bincount(cell, v, width * n_bins).reshape(width, n_bins), 1) for v in (g, h)]
            total = [s[:, -1:] for s in sums]
            right = [t - s for s, t in zip(sums, total, strict=True)]
            score = lambda a, b: a * a / (b + 1.0)
            gain = score(*sums) + score(*right) - score(*total)
            gain[(sums[1] < least) | (right[1] < least)] = 0
            gain[:, len(edges[f]) :] = 0
            pick = gain.argmax(1)
            found = gain[np.arange(width), pick]
            better = found > best_gain
            best_gain[better], best_f[better], best_b[better] = found[better], f, pick[better]
        for i in np.flatnonzero(best_b >= 0):
            tree.feature[first + i], tree.cut[first + i] = best_f[i], edges[best_f[i]][best_b[i]]
        split = best_b[at - first]
        goes_right = (split >= 0) & (binned[np.arange(n), best_f[at - first]] > split)
        at = 2 * at + 1 + goes_right
    leaf = at - (2**depth - 1)
    top, weight = np.bincount(leaf, g, 2**depth), np.bincount(leaf, h, 2**depth)
    tree.value = top / (weight + 1.0)
    return tree


class Boosted:
    """One sum of trees per class, turned into probabilities by softmax."""

    def __init__(self, base: np.ndarray, trees: list[list[Tree]], rate: float):
        self.base, self.trees, self.rate = base, trees, rate

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        scores = np.tile(self.base, (len(x), 1))
        for round_ in self.trees:
            for c, tree in enumerate(round_):
                scores[:, c] += self.rate * tree.predict(x)
        scores -= scores.max(1, keepdims=True)
        return scores - np.log(np.exp(scores).sum(1, keepdims=True))


def fit(x: np.ndarray, y: np.ndarray, n_classes: int, *, rounds: int = 24, depth: int = 4, rate: float = 0.35, bins: int = 20, least: float = 2.0) -> Boosted:
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    edges = [e[e < x[:, f].max()] if len(e) else e for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    share = (np.bincount(y, minlength=n_classes) + 1.0) / (len(y) + n_classes)
    base = np.log(share)
    model = Boosted(base, [], rate)
    scores = np.tile(base, (len(x), 1))
    binned = np.asfortranarray(binned)
    useful, draw = [f for f, e in enumerate(edges) if len(e)], np.random.default_rng(0)
    for _ in range(rounds):
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        round_ = []
        for c in range(n_classes):
            used = sorted(draw.choice(useful, max(1, len(useful) // 2), replace=False).tolist()) if useful else []
            tree = _grow(binned, edges, used, (y == c) - p[:, c], p[:, c] * (1 - p[:, c]) + 1e-6, depth, least)
            round_.append(tree)
        for c, tree in enumerate(round_):
            scores[:, c] += rate * tree.predict(x)
        model.trees.append(round_)
    return model
