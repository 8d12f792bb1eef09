"""Nearest entry by a geometric near-neighbour access tree (GNAT), for many integer
vectors at once (NumPy, used inside tasks).

A node holds a few split points; every other entry belongs to its nearest one.  For
each pair of split points the node keeps the range of distances from the first to the
second and its entries.  A query that measured its distance to a split point drops
each child whose range lies strictly outside that distance plus or minus the best
found: roots are rounded down on the near and up on the far side, so a child that
could hold a nearer or equally near entry always stays.  Ties go to the lower index
by comparing exact integer squares.
"""

from __future__ import annotations

import math

import numpy as np

DEGREE = 4


def floor_root(squares: np.ndarray) -> np.ndarray:
    """Integer square roots, rounded down, exact."""
    if squares.dtype == object:
        return np.array([math.isqrt(int(s)) for s in squares], object)
    root = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    root -= root * root > squares
    root += (root + 1) * (root + 1) <= squares
    return root


def ceil_root(squares: np.ndarray) -> np.ndarray:
    root = floor_root(squares)
    return root + (root * root < squares)


def squares(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = vectors - point
    return (gap * gap).sum(axis=1) if gap.shape[1] else np.zeros(len(gap), vectors.dtype)


class Node:
    """Split points of ``members`` (entry numbers) and the children below them."""

    def __init__(self, entries: np.ndarray, members: np.ndarray, degree: int = DEGREE):
        points = entries[members]
        # Split points far from each other, starting with the first entry.
        splits, nearest = [0], squares(points, points[0])
        while len(splits) < min(degree, len(members)):
            far = int(nearest.argmax())
            if far in splits:                            # only copies are left
                far = min(set(range(len(members))) - set(splits))
            splits.append(far)
            nearest = np.minimum(nearest, squares(points, points[far]))
        self.splits = members[splits]
        between = np.stack([squares(points, points[s]) for s in splits])
        home = between.argmin(axis=0)
        home[splits] = np.arange(len(splits))
        k = len(splits)
        self.low = np.empty((k, k), entries.dtype)
        self.high = np.empty((k, k), entries.dtype)
        self.children: list[Node | None] = []
        for j in range(k):
            inside = np.flatnonzero(home == j)
            self.low[:, j] = floor_root(between[:, inside].min(axis=1))
            self.high[:, j] = ceil_root(between[:, inside].max(axis=1))
            rest = members[np.setdiff1d(inside, splits)]
            self.children.append(Node(entries, rest, degree) if len(rest) else None)


class Gnat:
    def __init__(self, entries: np.ndarray, degree: int = DEGREE):
        self.entries = entries
        self.root = Node(entries, np.arange(len(entries)), degree)
        self.measured = 0                                # distances computed so far

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry number, squared distance) of each vector's nearest entry."""
        n = len(vectors)
        index = np.full(n, -1, np.int64)
        best = np.zeros(n, self.entries.dtype)
        self._visit(self.root, vectors, np.arange(n), index, best)
        return index, best

    def _visit(self, node: Node, vectors, rows, index, best) -> None:
        k = len(node.splits)
        alive = np.ones((len(rows), k), bool)
        for i, entry in enumerate(node.splits.tolist()):
            here = np.flatnonzero(alive[:, i])
            if not len(here):
                continue
            at = rows[here]
            d = squares(vectors[at], self.entries[entry])
            self.measured += len(at)
            old, held = best[at], index[at]
            better = (held < 0) | (d < old) | ((d == old) & (entry < held))
            index[at[better]], best[at[better]] = entry, d[better]
            reach, near, far = ceil_root(best[at]), floor_root(d), ceil_root(d)
            out = (near[:, None] - reach[:, None] > node.high[i]) \
                | (far[:, None] + reach[:, None] < node.low[i])
            alive[here] &= ~out.astype(bool)
        for j, child in enumerate(node.children):
            if child is not None:
                left = rows[alive[:, j]]
                if len(left):
                    self._visit(child, vectors, left, index, best)
