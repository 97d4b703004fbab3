"""Shared frame of the two vector searches: distinct vectors, shards, query blocks.

Queries are searched against all rows in blocks: distinct vectors are packed
into shards of about ``SHARD_ROWS`` and distinct query vectors into blocks of about
``BLOCK_ROWS``; every block meets every shard once, and a searcher (a function
on numpy arrays) returns the best few rows of the shard for each query. All
rows of one vector are one entry that keeps its ``top + 1`` smallest ids, which
is all that any query can return of them, so copies of one vector meet each
other once, however many there are. The best of all shards are merged per distinct query
vector and then handed to each query with that vector.

Rows whose id is null, or whose vector is null, empty or holds null or
non-finite components, take no part. An id given repeatedly counts once, with its
smallest vector. Vectors of different lengths are not compared. Ties in the score go to the
smaller id; a query without candidates has no rows; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_arrow, stored

SHARD_ROWS, BLOCK_ROWS = 16_384, 1_024

#: (vectors, smallest ids, queries, thresholds) -> for each query (row numbers, scores)
Searcher = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]


def usable(rows: DataFrame, id_col: str, vector_col: str, component: Callable[[Column], Column],
           nonzero: bool) -> DataFrame:
    """(vec_id, vec) of the rows that take part, ``component`` applied to each double."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    whole = (F.size(x) > 0) & ~bad
    if nonzero:
        whole &= F.exists(x, lambda c: c != 0)
    return (rows.where(F.col(id_col).isNotNull() & x.isNotNull() & whole)
            .select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, component).alias("vec"))
            .groupBy("vec_id").agg(F.min("vec").alias("vec")))


def _packed(rows: DataFrame, group: str, size: int, *columns: str) -> DataFrame:
    """(dim, group, items): rows packed by a hash of their vector, about ``size`` in each group."""
    groups = max(1, -(-rows.count() // size))
    return (rows.withColumn(group, F.pmod(F.xxhash64("vec"), F.lit(groups)))
            .groupBy(F.size("vec").alias("dim"), group)
            .agg(F.collect_list(F.struct("vec", *columns)).alias(f"{group}_items")))


def _matrix(items: pa.Array, dim: int) -> np.ndarray:
    return items.field("vec").flatten().to_numpy(zero_copy_only=False).reshape(len(items), dim)


def nearest(rows: DataFrame, queries: Column, top: int, score_type: str, searcher: Searcher,
            propagate: bool) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` best rows found for each query, best first.

    ``rows`` has (vec_id, vec), ``queries`` tells which are queries. With ``propagate`` each
    block first searches one shard, and the score of the last row kept there
    is the others' threshold.
    """
    rows = stored(rows, "vectors")
    by_id = Window.partitionBy("vec").orderBy("vec_id")
    entries = stored(
        rows.withColumn("_n", F.row_number().over(by_id)).where(F.col("_n") <= top + 1)
        .groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "vector-entries")
    asked = rows.where(queries)
    asked_entries = asked.groupBy("vec").agg(F.min("vec_id").alias("leader"))
    shards = stored(_packed(entries, "shard", SHARD_ROWS, "ids"), "vector-shards")
    blocks = stored(_packed(asked_entries, "block", BLOCK_ROWS, "leader"), "vector-blocks")
    # block b starts with the shard numbered b in turn among those of its dimension
    places = shards.select("dim", "shard", (F.row_number().over(
        Window.partitionBy("dim").orderBy("shard")) - 1).alias("place"))
    pairs = (blocks.select("dim", "block").join(places, "dim")
             .withColumn("first", F.col("place") == F.pmod("block", F.count("*").over(
                 Window.partitionBy("dim", "block")))))
    pairs = stored(pairs.select("dim", "block", "shard", "first"), "vector-pairs")
    schema = f"leader long, vec_id long, score {score_type}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _search(batch.slice(i, 1), top, score_type, searcher)

    def searched(part: DataFrame, thresholds: DataFrame | None) -> DataFrame:
        met = part.join(blocks, ["dim", "block"]).join(shards, ["dim", "shard"])
        if thresholds is not None:
            met = met.join(thresholds, ["dim", "block"], "left")
        else:
            met = met.withColumn("least", F.lit(None).cast(f"map<bigint,{score_type}>"))
        return map_arrow(met.select("dim", "block_items", "shard_items", "least"), work, schema)

    if propagate:
        first = stored(searched(pairs.where("first"), None), "vectors-found")
        last = (first.withColumn("_n", F.row_number().over(_best("leader")))
                .where(F.col("_n") == top + 1))
        which = blocks.select("dim", "block", F.explode("block_items.leader").alias("leader"))
        least = (which.join(last, "leader").groupBy("dim", "block")
                 .agg(F.map_from_entries(F.collect_list(F.struct("leader", "score"))).alias("least")))
        found = first.unionByName(searched(pairs.where("not first"), least))
    else:
        found = searched(pairs, None)
    kept = (found.withColumn("_n", F.row_number().over(_best("leader")))
            .where(F.col("_n") <= top + 1).drop("_n"))
    members = (asked.join(asked_entries, "vec").select(F.col("vec_id").alias("query_id"), "leader"))
    return (members.join(stored(kept, "vectors-kept"), "leader").where("query_id <> vec_id")
            .withColumn("rank", F.row_number().over(_best("query_id"))).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))


def _best(key: str):
    return Window.partitionBy(key).orderBy(F.col("score").desc(), "vec_id")


def _search(pair: pa.RecordBatch, top: int, score_type: str, searcher: Searcher) -> pa.RecordBatch:
    """One block against one shard; the ids and scores that may be among the best."""
    dim = pair.column(0)[0].as_py()
    block, shard = pair.column(1).flatten(), pair.column(2).flatten()
    ids = shard.field("ids")
    starts, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
    leaders = block.field("leader").to_numpy()
    least = dict(pair.column(3)[0].as_py() or ())
    floor = np.array([least.get(x, -np.inf) for x in leaders.tolist()], float)
    out: list[tuple] = [], [], []
    found = searcher(_matrix(shard, dim), flat[starts[:-1]], _matrix(block, dim), floor)
    for leader, (rows, scores) in zip(leaders.tolist(), found, strict=True):
        sizes = starts[rows + 1] - starts[rows]
        at = np.repeat(starts[rows] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) \
            + np.arange(sizes.sum())
        vec_ids, repeated = flat[at], np.repeat(scores, sizes)
        best = np.lexsort((vec_ids, -repeated))[:top + 1]
        out[0].append(np.full(len(best), leader))
        out[1].append(vec_ids[best])
        out[2].append(repeated[best])
    kinds = (pa.int64(), pa.int64(), pa.int64() if score_type == "long" else pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(c) if c else [], k) for c, k in zip(out, kinds, strict=True)],
        names=["leader", "vec_id", "score"])


def best_rows(scores: np.ndarray, first_ids: np.ndarray, count: int) -> np.ndarray:
    """Numbers of the ``count`` best scores, ties to the smaller first id."""
    if len(scores) > count:
        least = np.partition(scores, len(scores) - count)[len(scores) - count]
        among = np.flatnonzero(scores >= least)
    else:
        among = np.arange(len(scores))
    return among[np.lexsort((first_ids[among], -scores[among]))[:count]]
