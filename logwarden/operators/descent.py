"""Rows sent down many trees at once, with a node in one machine word."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd

#: Batches that are scored together, and rows that go down a tree together.
BATCHES, ROWS = 10, 16_384


class Trees:
    """Trees given as (feature, value, child): see :func:`logwarden.operators.forest.grow`.

    A word holds the rank of the node's value among all values of its feature, the number of its first child, and the
    feature.  A row's ranks are looked up once, so each step down is a comparison of words.  Leaves lead to themselves.
    """

    def __init__(self, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], width: int) -> None:
        self.values = [np.unique(np.concatenate([value[feature == f] for feature, value, _ in trees] or [np.zeros(0)])) for f in range(width)]
        self.feature_bits = max(1, (width - 1).bit_length())
        self.child_bits = max((len(feature).bit_length() for feature, _, _ in trees), default=1)
        self.rank_bits = max((len(v) + 1).bit_length() for v in self.values) if width else 1
        if self.feature_bits + self.child_bits + self.rank_bits > 62:
            raise ValueError("trees are too large")
        self.trees = [self._words(*tree) for tree in trees]

    def _words(self, feature: np.ndarray, value: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        leaf = feature < 0
        rank = np.full(len(feature), (1 << self.rank_bits) - 1, dtype=np.int64)
        for f in np.unique(feature[~leaf]):
            places = np.flatnonzero(feature == f)
            rank[places] = np.searchsorted(self.values[f], value[places])
        to = np.where(leaf, np.arange(len(feature)), child).astype(np.int64)
        words = (rank << (self.feature_bits + self.child_bits)) | (to << self.feature_bits) | np.where(leaf, 0, feature).astype(np.int64)
        ends, code = np.unique(value[leaf], return_inverse=True)
        codes = np.zeros(len(feature), dtype=np.min_scalar_type(max(len(ends) - 1, 0)))
        codes[leaf] = code
        return words, codes, ends

    def total(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves' values over the trees; a row goes to the right if its value is larger or not a number."""
        return np.concatenate([self._total(x[i : i + ROWS]) for i in range(0, len(x), ROWS)] or [np.zeros(0)])

    def _total(self, x: np.ndarray) -> np.ndarray:
        n, width = x.shape
        total = np.zeros(n)
        low = self.feature_bits + self.child_bits
        ranks = np.stack([np.searchsorted(v, x[:, f]) for f, v in enumerate(self.values)], axis=1).astype(np.int64).ravel() << low
        which, child, leaf = (1 << self.feature_bits) - 1, (1 << self.child_bits) - 1, ((1 << self.rank_bits) - 1) << low
        for words, codes, ends in self.trees:
            at = np.arange(n)
            first = at * width
            word = np.full(n, words[0])
            node = np.zeros(n, dtype=np.int64)
            while len(at):
                inner = word < leaf
                if not inner.all():
                    there = ~inner
                    total[at[there]] += ends[codes[node[there]]]
                    at, first, word = at[inner], first[inner], word[inner]
                for _ in range(4):  # looking for leaves costs as much as a step
                    place = word & which
                    place += first
                    right = ranks.take(place) > word
                    word >>= self.feature_bits
                    word &= child
                    word += right
                    node = word
                    word = words.take(node)
        return total


def by_blocks(batches: Iterator[pd.DataFrame], score: Callable[[np.ndarray], np.ndarray]) -> Iterator[pd.Series]:
    """Scores of batches of rows; equal rows next to each other are scored once, some batches at a time."""
    while block := [rows.to_numpy(dtype=float) for rows in islice(batches, BATCHES)]:
        x = np.concatenate(block)
        new = np.ones(len(x), dtype=bool)
        new[1:] = (x[1:] != x[:-1]).any(axis=1)
        scores = score(x[new])[np.cumsum(new) - 1]
        for part in np.split(scores, np.cumsum([len(b) for b in block])[:-1]):
            yield pd.Series(part)
