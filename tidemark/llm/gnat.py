"""Nearest entries of a codebook by a geometric near-neighbour access tree, exact on integer vectors.

A node takes a few far-apart entries as split points, and each other entry goes to its nearest split point's child. Of each
split point and each child the node keeps the least and greatest distance between the point and the child's entries. A query is
compared with one split point after the other; by the triangle inequality, a child all of whose entries have to be farther
than the best entry so far is never looked at, its split point included. It goes only where they are strictly farther,
with distances rounded against it, so entries at the same distance stay in play; which of them is nearer, and which of equal
ones has the lower index, is decided on integers.
"""

from __future__ import annotations

import numpy as np

# Split points of a node, and entries of a node without children.
ARITY, LEAF = 8, 8
# Distances are of integers below 2 ** 62, so a relative error of 1e-12 is far beyond that of a double's square root.
_UP, _DOWN = 1 + 1e-12, 1 - 1e-12


def squared(points: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points from one entry."""
    apart = points - entry
    return (apart * apart).sum(axis=1)


class Tree:
    """``entries``: a matrix of integers, a row an entry: int64, or Python's own. The latter may have no root in a double, so
    such a tree is one leaf."""

    def __init__(self, entries: np.ndarray, arity: int = ARITY, leaf: int = LEAF):
        self.entries, self.arity, self.leaf = entries, arity, max(leaf, len(entries) if entries.dtype == object else 0)
        self.compared = 0
        self.root = self._node(np.arange(len(entries)))

    def _node(self, at: np.ndarray):
        if len(at) <= self.leaf:
            return at, None, None, None
        points, far = self.entries[at], []
        chosen = [0]
        while True:
            far.append(squared(points, points[chosen[-1]]))
            least = np.min(far, axis=0)
            furthest = int(np.argmax(least))
            if len(chosen) == self.arity or not least[furthest]:
                break
            chosen.append(furthest)
        far = np.array(far)
        of = np.argmin(far, axis=0)
        of[chosen] = np.arange(len(chosen))
        members = [np.flatnonzero(of == c) for c in range(len(chosen))]
        low = np.array([[_root(far[i][m].min(), _DOWN) for m in members] for i in range(len(chosen))])
        high = np.array([[_root(far[i][m].max(), _UP) for m in members] for i in range(len(chosen))])
        children = [self._node(np.setdiff1d(at[m], at[[c]])) for m, c in zip(members, chosen)]
        return at[chosen], low, high, children

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each point's nearest entry, the lower one of equals, and the squared distance."""
        best = np.full(len(points), -1, np.int64)
        # -1: nothing yet; any distance is below it.
        least = np.full(len(points), -1, points.dtype)
        if len(points) and len(self.entries):
            self._search(self.root, points, np.arange(len(points)), best, least)
        return best, least

    def _compare(self, entry: int, points: np.ndarray, rows: np.ndarray, best: np.ndarray, least: np.ndarray) -> np.ndarray:
        apart = squared(points[rows], self.entries[entry])
        self.compared += len(rows)
        was = least[rows]
        better = (was < 0) | (apart < was) | ((apart == was) & (entry < best[rows]))
        better = better.astype(bool)
        best[rows[better]] = entry
        least[rows[better]] = apart[better]
        return apart

    def _search(self, node, points: np.ndarray, rows: np.ndarray, best: np.ndarray, least: np.ndarray) -> None:
        splits, low, high, children = node
        if children is None:
            for entry in splits:
                self._compare(entry, points, rows, best, least)
            return
        alive = np.ones((len(rows), len(splits)), bool)
        near, far = np.full(alive.shape, -np.inf), np.full(alive.shape, np.inf)
        for i, entry in enumerate(splits):
            here = np.flatnonzero(alive[:, i])
            if not len(here):
                continue
            apart = np.sqrt(self._compare(entry, points, rows[here], best, least).astype(np.float64))
            near[here, i], far[here, i] = apart * _DOWN, apart * _UP
            reach = np.sqrt(least[rows[here]].astype(np.float64)) * _UP
            alive[here] &= ~_beyond(near[here, i], far[here, i], reach, low[i], high[i])
        for j, child in enumerate(children):
            here = np.flatnonzero(alive[:, j])
            if not len(child[0]) or not len(here):
                continue
            # Nearer entries may have turned up since.
            reach = np.sqrt(least[rows[here]].astype(np.float64)) * _UP
            gone = (low[:, j] > far[here] + reach[:, None]) | (high[:, j] < near[here] - reach[:, None])
            self._search(child, points, rows[here[~gone.any(axis=1)]], best, least)


def _root(square: int, rounded: float) -> float:
    return float(square) ** 0.5 * rounded


def _beyond(near: np.ndarray, far: np.ndarray, reach: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether all of a child is strictly farther than ``reach``, by its distances from a split point at ``near`` to ``far``."""
    return (low[None, :] > (far + reach)[:, None]) | (high[None, :] < (near - reach)[:, None])
