"""Gradient-boosted trees for several classes, on binned features (numpy)."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Softmax boosting: per round one regression tree of fixed depth per class,
    grown level by level on histograms of gradients."""

    def __init__(self, rounds: int = 20, depth: int = 4, rate: float = 0.3, bins: int = 24, penalty: float = 1.0) -> None:
        self.rounds, self.depth, self.rate, self.bins, self.penalty = rounds, depth, rate, bins, penalty

    def fit(self, x: np.ndarray, y: np.ndarray, classes: int) -> BoostedTrees:
        n, f = x.shape
        self.classes = classes
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(f)]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        score = np.zeros((n, classes))
        onehot = np.eye(classes)[y]
        self.trees = []
        for _ in range(self.rounds):
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for c in range(classes):
                tree = self._tree(binned, p[:, c] - onehot[:, c], p[:, c] * (1 - p[:, c]) + 1e-6, cuts)
                self.trees.append(tree)
                score[:, c] += self._apply(tree, x)
        return self

    def _tree(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray, cuts: list[np.ndarray]):
        n, f = binned.shape
        inner = (1 << self.depth) - 1
        feature = np.zeros(inner, dtype=np.int64)
        threshold = np.full(inner, np.inf)
        node = np.zeros(n, dtype=np.int64)
        for level in range(self.depth):
            base, width = (1 << level) - 1, 1 << level
            gain = np.zeros(width)
            for j in range(f):
                if not len(cuts[j]):
                    continue
                key = (node - base) * self.bins + binned[:, j]
                gs = np.bincount(key, g, width * self.bins).reshape(width, self.bins).cumsum(axis=1)
                hs = np.bincount(key, h, width * self.bins).reshape(width, self.bins).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                value = gs ** 2 / (hs + self.penalty) + (gt - gs) ** 2 / (ht - hs + self.penalty) - gt ** 2 / (ht + self.penalty)
                value = value[:, :len(cuts[j])]
                best = value.argmax(axis=1)
                better = value[np.arange(width), best] > gain + 1e-9
                gain[better] = value[np.arange(width), best][better]
                feature[base:base + width][better] = j
                threshold[base:base + width][better] = cuts[j][best[better]]
            split = feature[node]
            column = np.array([np.searchsorted(cuts[j], t, side="left") if len(cuts[j]) and np.isfinite(t) else self.bins
                               for j, t in zip(feature, threshold)])
            node = 2 * node + 1 + (binned[np.arange(n), split] > column[node])
        leaf = node - inner
        gs, hs = np.bincount(leaf, g, 1 << self.depth), np.bincount(leaf, h, 1 << self.depth)
        return feature, threshold, -self.rate * gs / (hs + self.penalty)

    def _apply(self, tree, x: np.ndarray) -> np.ndarray:
        feature, threshold, leaf = tree
        flat, stride = x.reshape(-1), x.shape[1]
        first = np.arange(len(x)) * stride
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + (flat[first + feature[node]] > threshold[node])
        return leaf[node - len(feature)]

    def log_proba(self, x: np.ndarray) -> np.ndarray:
        score = np.zeros((len(x), self.classes))
        for k, tree in enumerate(self.trees):
            score[:, k % self.classes] += self._apply(tree, x)
        score -= score.max(axis=1, keepdims=True)
        return score - np.log(np.exp(score).sum(axis=1, keepdims=True))
