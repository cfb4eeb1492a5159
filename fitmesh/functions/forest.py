"""Evaluation of binary trees stored as flat arrays."""

from __future__ import annotations

import numpy as np


class FlatForest:
    """Trees laid end to end; child positions are relative to the tree's root, ``feature = -1`` is a leaf."""

    def __init__(self, tree, feature, threshold, left, right, value):
        tree = np.asarray(tree, dtype=int)
        self.feature = np.asarray(feature, dtype=int)
        self.threshold = np.asarray(threshold, dtype=float)
        self.left, self.right = np.asarray(left, dtype=int), np.asarray(right, dtype=int)
        self._child = np.stack([self.left, self.right], 1).ravel()
        self.value = np.asarray(value, dtype=float)
        self.roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])

    def leaves(self, x: np.ndarray, root: int) -> np.ndarray:
        """Array position of each row's leaf in the tree that starts at ``root``."""
        at = np.full(len(x), root)
        if self.feature[root] < 0:
            return at
        live, here = np.arange(len(x)), at
        while len(live):
            right = ~(x[live, self.feature[here]] <= self.threshold[here])
            here = root + self._child[2 * here + right]
            at[live] = here
            inner = self.feature[here] >= 0
            live, here = live[inner], here[inner]
        return at

    def mean(self, x: np.ndarray) -> np.ndarray:
        """Average leaf value over the trees."""
        total = np.zeros(len(x))
        for root in self.roots:
            total += self.value[self.leaves(x, root)]
        return total / len(self.roots)
