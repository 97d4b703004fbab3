"""Approximate nearest neighbours by a hash-prefix forest (operator 2).

Each of ``TREES`` trees gives a vector a string of ``BITS`` bits, the sides of random
hyperplanes it lies on, and keeps the strings of a shard in a sorted array, so
that the vectors sharing a prefix stand next to each other. A query
descends to the longest prefixes it matches in each tree, then ascends in all
trees at once, one bit a step, until the vectors below its prefixes make up
``PROBE`` of the shard; these candidates are scored on the original vectors.
The probed share sets recall against cost, alike at every size; on vectors
without any structure (the test tables') a share of this order is what a recall of
0.9 takes.

Inner products become angles by one more component, sqrt(M^2 - |x|^2) for rows
(M: the largest norm) and 0 for queries. Scores are inner products summed
in double precision from the first component to the last. See ``vectors`` for nulls,
ties, repeated rows and empty tables; zero vectors take no part.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .vectors import best_rows, nearest, usable

TREES, BITS = 24, 32
PROBE = 0.7
SEED = 20


class Forest:
    """Sorted arrays of hash strings over the rows of a shard."""

    def __init__(self, x: np.ndarray, norm: float, trees: int = TREES, bits: int = BITS):
        self.x, self.trees, self.bits = x, trees, bits
        self.planes = np.random.default_rng(SEED).standard_normal((x.shape[1] + 1, trees * bits))
        rest = np.sqrt(np.maximum(norm ** 2 - (x * x).sum(axis=1), 0))
        strings = self.strings(x, rest)
        self.order = np.argsort(strings, axis=0, kind="stable").T.copy()
        self.sorted = np.stack([strings[o, t] for t, o in enumerate(self.order)])

    def strings(self, x: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Hash strings, the first bit highest: (vectors, trees)."""
        side = (x @ self.planes[:-1] + rest[:, None] * self.planes[-1]) > 0
        weight = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        return side.reshape(len(x), self.trees, self.bits) @ weight

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the matches of each prefix length start and end: (length, tree, query)."""
        strings = self.strings(queries, np.zeros(len(queries)))
        start = np.empty((self.bits + 1, self.trees, len(queries)), np.int64)
        end = np.empty_like(start)
        for length in range(self.bits + 1):
            step = 1 << (self.bits - length)
            low = strings // step * step
            for t in range(self.trees):
                start[length, t] = np.searchsorted(self.sorted[t], low[:, t])
                end[length, t] = np.searchsorted(self.sorted[t], low[:, t] + step)
        return start, end

    def candidates(self, start: np.ndarray, end: np.ndarray, goal: int) -> np.ndarray:
        """Rows below the longest synchronous prefixes with at least ``goal`` rows; (length, tree) ranges."""
        below = (end - start).sum(axis=1)
        length = int(np.flatnonzero(below >= goal)[-1])  # deeper ones can't reach the goal
        while True:
            hit = np.zeros(len(self.x), bool)
            for t in range(self.trees):
                hit[self.order[t, start[length, t]:end[length, t]]] = True
            if length == 0 or np.count_nonzero(hit) >= goal:
                return np.flatnonzero(hit)
            length -= 1


def search(x: np.ndarray, first_ids: np.ndarray, queries: np.ndarray, norm: float, top: int,
           probe: float = PROBE) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the best ``top`` rows among its candidates, with scores."""
    forest = Forest(x, norm)
    start, end = forest.ranges(queries)
    goal = min(len(x), max(top, int(np.ceil(probe * len(x)))))
    out = []
    for q, query in enumerate(queries):
        rows = forest.candidates(start[:, :, q], end[:, :, q], goal)
        rough = x[rows] @ query
        # the scores of record are summed in one order, whatever the block: a few spare rows go along
        rows = rows[best_rows(rough, first_ids[rows], top + 12)]
        scores = np.cumsum(x[rows] * query, axis=1)[:, -1]
        best = best_rows(scores, first_ids[rows], top)
        out.append((rows[best], scores[best]))
    return out


def approximate_nearest(rows: DataFrame, queries: Column | None = None, top: int = 20,
                        id_col: str = "vec_id", vector_col: str = "embedding",
                        probe: float = PROBE) -> DataFrame:
    """(query_id, rank int, vec_id, score double): about the ``top`` largest inner products.

    ``queries`` (on ``vec_id``; default: ids divisible by 20) tells which rows are queries.
    """
    queries = F.col("vec_id") % 20 == 0 if queries is None else queries
    vectors = stored(usable(rows, id_col, vector_col, lambda c: c, nonzero=True), "forest-vectors")
    squares = F.aggregate("vec", F.lit(0.0), lambda s, c: s + c * c)
    norm = vectors.agg(F.max(F.sqrt(squares))).first()[0] or 0.0

    def searcher(x, first_ids, asked, _floor):
        return search(x, first_ids, asked, norm, top + 1, probe)

    return nearest(vectors, queries, top, "double", searcher, propagate=False)
