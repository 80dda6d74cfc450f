"""Exact inner-product search of sparse vectors of integers, by a ball tree.

A node holds the mean of its vectors and a radius around it.  No vector of the
node has a larger inner product with a query than the mean has, plus the
query's length times the radius; of the query only the terms that occur in the
node count.  Nodes are visited by that bound, the greatest first, until it falls
under the k-th score found.  Bounds are doubles, rounded up by more than their
error; scores at the leaves are sums of 64-bit integers.
"""

from __future__ import annotations

import heapq

import numpy as np

#: Bounds and radii are raised by this part of them: far more than the rounding errors of sums of doubles.
SLACK = 1e-9


class BallTree:
    """Vectors as rows of (terms, values), ``sizes`` entries each, none empty; terms are below ``width``."""

    def __init__(self, terms: np.ndarray, values: np.ndarray, sizes: np.ndarray, width: int, leaf: int = 64):
        self.width, self.leaf = width, leaf
        self.children: list[tuple[int, int] | None] = []
        self.leaves: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        self._means: list[np.ndarray] = []
        self._radii: list[float] = []
        if len(sizes):
            self._build(np.arange(len(sizes)), terms, values, sizes)
        self.means = np.ascontiguousarray(np.array(self._means).reshape(len(self._means), width).T)
        self.radii = np.array(self._radii)
        del self._means
        self._wanted = np.zeros(width, np.bool_)

    def _build(self, rows: np.ndarray, terms: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> None:
        """All nodes, parents before children."""
        todo: list[tuple[int | None, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = [(None, rows, terms, values, sizes)]
        while todo:
            parent, rows, terms, values, sizes = todo.pop()
            me = len(self.children)
            if parent is not None:
                before = self.children[parent]
                self.children[parent] = (me, -1) if before is None else (before[0], me)
            self.children.append(None)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            reals = values.astype(np.float64)
            squares = np.add.reduceat(reals * reals, starts)
            mean = np.bincount(terms, weights=reals, minlength=self.width) / len(rows)
            away = self._distances(terms, reals, starts, squares, mean)
            self._means.append(mean)
            self._radii.append(float(np.sqrt(away.max())) * (1 + SLACK))
            if len(rows) <= self.leaf:
                self.leaves[me] = (rows, terms, values, starts)
                continue
            first = self._distances(terms, reals, starts, squares, self._row(int(away.argmax()), terms, reals, starts, sizes))
            second = self._distances(terms, reals, starts, squares, self._row(int(first.argmax()), terms, reals, starts, sizes))
            left = np.zeros(len(rows), np.bool_)
            left[np.argsort(first - second, kind="stable")[: len(rows) // 2]] = True
            for side in (~left, left):
                entries = np.repeat(side, sizes)
                todo.append((me, rows[side], terms[entries], values[entries], sizes[side]))

    def _row(self, at: int, terms: np.ndarray, reals: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        own = slice(int(starts[at]), int(starts[at] + sizes[at]))
        out = np.zeros(self.width)
        out[terms[own]] = reals[own]
        return out

    @staticmethod
    def _distances(terms: np.ndarray, reals: np.ndarray, starts: np.ndarray, squares: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Squared distances of all rows to a point, never below the true ones."""
        whole = squares + to @ to
        return np.maximum(whole - 2 * np.add.reduceat(reals * to[terms], starts), 0) + 1e-12 * whole

    def bounds(self, query: np.ndarray) -> np.ndarray:
        """For each node, a number that the inner product of none of its vectors with the query (a set of terms) exceeds."""
        part = self.means[query]
        shared = (part > 0).sum(axis=0)
        return np.where(shared > 0, (part.sum(axis=0) + np.sqrt(shared) * self.radii) * (1 + SLACK) + 1, 0)

    def search(self, query: np.ndarray, k: int, least: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
        """(rows, scores, leaves visited): all rows that score ``least`` or more and as much as the ``k``-th best, ties included."""
        rows, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if not self.children or not len(query):
            return rows[0], scores[0], 0
        bounds = self.bounds(query)
        heap = [(-bounds[0], 0)]
        visited, held = 0, 0
        self._wanted[query] = True
        while heap and -heap[0][0] >= least:
            _, node = heapq.heappop(heap)
            pair = self.children[node]
            if pair is not None:
                for child in pair:
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            visited += 1
            own, terms, values, starts = self.leaves[node]
            found = np.add.reduceat(values * self._wanted[terms], starts)
            good = found >= least
            if good.any():
                rows.append(own[good])
                scores.append(found[good])
                held += int(good.sum())
                if held >= k:
                    every, these = np.concatenate(scores), np.concatenate(rows)
                    least = max(least, int(np.partition(every, len(every) - k)[len(every) - k]))
                    keep = every >= least
                    rows, scores, held = [these[keep]], [every[keep]], int(keep.sum())
        self._wanted[query] = False
        return np.concatenate(rows), np.concatenate(scores), visited
