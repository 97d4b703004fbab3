"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on distinct links (a > b).

    Large: every larger neighbour of a node is linked to the least of the node and its
    neighbours. Small: a node and its smaller neighbours are linked to the least of these.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        out = (edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select("a", F.col("m").alias("b"))))
    return out.where("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of a link: the smallest node that links lead to.

    Links may repeat, go either way and join a node to itself. Minima are
    aggregated before the shuffle, so a node with very many links is no hot
    spot; each round is written to the shared folder. Rounds grow with the
    logarithm of the number of nodes.
    """
    edges = stored(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                   .select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    mark = None
    for _ in range(most_rounds):
        edges = stored(_star(_star(edges, True), False), "links")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("links did not settle")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(roots.select("node", F.col("node").alias("component"))))
