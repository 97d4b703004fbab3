"""Exact top-k search by KD-trees (operator 6).

Each shard of the rows is a KD-tree: median splits along the widest
dimension down to leaves of at most ``LEAF`` rows, every node with its tight
bounding box. The largest inner product that a box allows, the sum over
dimensions of max(q low, q high), bounds what its rows can score. A query
visits leaves best bound first and stops at the first bound below its kth
score; that score starts from the one reached in the shard its block was searched in
first. The queries of a block advance together, one leaf each a round.

Components are integers, floor(64 x). Sums are exact: in doubles while they stay
below 2**53, else in 64-bit integers (beyond which an error is raised). See
``vectors`` for nulls, ties, repeated rows and empty tables.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import best_rows, nearest, usable

LEAF = 256
SCALE = 64


class Tree:
    """Leaves (row numbers) of median splits, and the boxes of all nodes.

    Node i has children 2i + 1 and 2i + 2; ``leaf`` maps a node to its rows.
    """

    def __init__(self, x: np.ndarray, leaf_rows: int = LEAF):
        self.low: dict[int, np.ndarray] = {}
        self.high: dict[int, np.ndarray] = {}
        self.leaf: dict[int, np.ndarray] = {}
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            own = x[rows]
            low, high = own.min(axis=0), own.max(axis=0)
            self.low[node], self.high[node] = low, high
            widest = int((high - low).argmax())
            if len(rows) <= leaf_rows or high[widest] == low[widest]:
                self.leaf[node] = rows
            else:
                half = len(rows) // 2
                order = np.argpartition(own[:, widest], half)
                todo += [(2 * node + 1, rows[order[:half]]), (2 * node + 2, rows[order[half:]])]

    def bounds(self, queries: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Nodes, and for each query and node the most that a row in its box can score."""
        nodes = sorted(self.low)
        low = np.stack([self.low[n] for n in nodes])
        high = np.stack([self.high[n] for n in nodes])
        return nodes, np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def search(x: np.ndarray, first_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray,
           top: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the best ``top`` rows and scores, of those that reach ``floor``."""
    largest = [float(np.abs(a).max(initial=0)) for a in (x, queries)]
    reach = largest[0] * largest[1] * x.shape[1]
    if reach >= 2.0 ** 63:
        raise OverflowError("inner products exceed 64 bits")
    kind = np.float64 if reach < 2.0 ** 53 else np.int64
    x, queries = x.astype(kind), queries.astype(kind)
    tree = Tree(x)
    nodes, bounds = tree.bounds(queries)
    place = {n: k for k, n in enumerate(nodes)}
    rows_of = [np.zeros(0, np.int64) for _ in queries]
    scores_of = [np.zeros(0, kind) for _ in queries]
    kth = floor.copy()
    # a priority queue of nodes for each query, by bound; its next leaf, when still worth a visit
    queues = [[(-bounds[q, 0], 0)] for q in range(len(queries))]
    active = list(range(len(queries)))
    while active:
        visits: dict[int, list[int]] = {}
        for q in active:
            queue = queues[q]
            while queue and -queue[0][0] >= kth[q]:
                _, node = heapq.heappop(queue)
                if node in tree.leaf:
                    visits.setdefault(node, []).append(q)
                    break
                for child in (2 * node + 1, 2 * node + 2):
                    heapq.heappush(queue, (-bounds[q, place[child]], child))
        active = []
        for node, asking in visits.items():
            rows = tree.leaf[node]
            for q, scores in zip(asking, queries[asking] @ x[rows].T, strict=True):
                good = scores >= kth[q]
                if good.any():
                    all_rows = np.concatenate((rows_of[q], rows[good]))
                    all_scores = np.concatenate((scores_of[q], scores[good]))
                    best = best_rows(all_scores, first_ids[all_rows], top)
                    rows_of[q], scores_of[q] = all_rows[best], all_scores[best]
                    if len(best) == top:
                        kth[q] = max(kth[q], scores_of[q][-1])
            active += asking
    return list(zip(rows_of, [s.astype(np.int64) for s in scores_of], strict=True))


def exact_nearest(rows: DataFrame, queries: Column | None = None, top: int = 20,
                  id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank int, vec_id, score long): the ``top`` largest inner products of each query.

    ``queries`` (on ``vec_id``; default: ids divisible by 20) tells which rows are queries.
    """
    queries = F.col("vec_id") % 20 == 0 if queries is None else queries
    vectors = usable(rows, id_col, vector_col, lambda c: F.floor(c * SCALE).cast("long"), nonzero=False)
    count = top + 1

    def searcher(x, first_ids, asked, floor):
        return search(x, first_ids, asked, floor, count)

    return nearest(vectors, queries, top, "long", searcher, propagate=True)
