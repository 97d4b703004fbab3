"""Merkle manifest of a table by lag and lead windows (operator 12), DataFrame operations only.

Every row becomes a leaf: the sha256 of its columns, each as its length and value. Rows of
a group are put in order, and level by level every ``FANOUT`` consecutive nodes (the
last run may be shorter) become one parent, the hash of their joined digests, until
one node is left; the groups' last nodes form a tree of their own in the same way.

* Order: a range partitioning by (group, id, leaf) numbers the rows inside each
  partition, and running counts over the partitions' sizes give places in the group. A group
  of any size is spread over many partitions, and rows alike in all columns are split by a row number.
* A level: nodes lie in blocks of ``FANOUT`` ** ``BLOCK_LEVELS`` places, in which fixed offsets of
  ``lag`` and ``lead``, masked by a node's slot and its run's length, give its siblings.
  Runs never cross a block, so a window holds at most a block, whatever the group's size. The
  first child of a run hashes its own digest and the ones that follow into the parent.
* Proofs: from the root down, each level hands its nodes the siblings of all levels above;
  a level is joined by the parent's place, which at most ``FANOUT`` rows share.

Ids may be null (before all others) or repeat: leaves ascend by id, then by digest,
and rows alike in every column are leaves of their own. A null group is a group,
before all others. An empty table gives an empty table; a single row is its own root, with
no siblings. Extra columns take no part unless they are named.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import others, stored

FANOUT = 8
#: Levels that one block of a window may still take part in: a block holds FANOUT ** BLOCK_LEVELS nodes.
BLOCK_LEVELS = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the joined UTF-8 bytes; digests go in as hex text."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else byte count, ``:`` and value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(*[field(v) for v in values])


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Add _pos (place within _group by ``order``, from 0) and _n (rows of the group).

    A global sort by (_group, order) numbers the rows of each partition; a partition's
    first place in a group is the number of the group's rows in earlier partitions.
    """
    dealt = nodes.repartitionByRange("_group", *order).sortWithinPartitions("_group", *order)
    at = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    part, line = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    at = at.withColumn("_part", part).withColumn("_line", line)
    # one row per partition and group: at most as many as partitions and groups together
    pieces = at.groupBy("_group", "_part").agg(F.count("*").alias("_rows"), F.min("_line").alias("_first"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("_group", "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_b"),
                            F.sum("_rows").over(Window.partitionBy("_group")).alias("_n"))
    return (at.join(offsets, ["_group", "_part"])
            .withColumn("_pos", F.col("_b") + F.col("_line") - F.col("_first"))
            .drop("_part", "_line", "_first", "_b", "_at"))


def with_siblings(nodes: DataFrame) -> DataFrame:
    """Add _before and _after: the joined digests of the run's nodes on either side (_group, _pos, _n, _node)."""
    slot = F.pmod("_pos", F.lit(FANOUT))
    length = F.least(F.lit(FANOUT), F.col("_n") - (F.col("_pos") - slot))
    block = F.expr(f"_pos div {FANOUT ** BLOCK_LEVELS}")
    near = Window.partitionBy("_group", block).orderBy("_pos")
    steps = range(1, FANOUT)
    lags = [F.when(slot >= k, F.lag("_node", k).over(near)) for k in steps]
    leads = [F.when(slot + k < length, F.lead("_node", k).over(near)) for k in steps]
    # concat_ws leaves out the masked places
    return nodes.withColumn("_before", F.concat_ws("", *reversed(lags))).withColumn("_after", F.concat_ws("", *leads))


def tree(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Levels of the groups' trees, lowest first, and the groups' roots.

    ``leaves``: (_group, _pos, _n, _node, any other columns). A level holds the nodes that have a
    parent, with _before and _after; a root row is (_group, _level, _node, any other columns of a lone leaf).
    """
    levels, roots, nodes, level = [], [], leaves, 0
    most = leaves.agg(F.max("_n")).first()[0] or 0
    while True:
        roots.append(nodes.where("_n = 1").select("_group", F.lit(level).alias("_level"), "_node"))
        if most <= 1:
            return levels, reduce(DataFrame.unionByName, roots)
        here = stored(with_siblings(nodes.where("_n > 1")), "merkle-level")
        levels.append(here)
        nodes = here.where(F.pmod("_pos", F.lit(FANOUT)) == 0).select(
            "_group", F.expr(f"_pos div {FANOUT}").alias("_pos"),
            F.expr(f"(_n + {FANOUT - 1}) div {FANOUT}").alias("_n"),
            digest(F.col("_node"), F.col("_after")).alias("_node"))
        most, level = -(-most // FANOUT), level + 1


def paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Hand every leaf the siblings of all levels: _path, lowest level first.

    ``tops``: (_group, _level, _path, any columns): what the group's root, found at _level, hands down.
    Returns the leaves' columns and those of ``tops``.
    """
    given = [c for c in tops.columns if c not in ("_group", "_level", "_path")]
    columns = [*leaves.columns, "_path", *given]
    own = F.array(F.struct(F.col("_before").alias("before"), F.col("_after").alias("after")))
    found = leaves.where("_n = 1").join(tops.select("_group", "_path", *given), "_group").select(*columns)
    above = None  # (_group, _parent, _path, given columns) of the level above
    for level in range(len(levels) - 1, -1, -1):
        seeds = tops.where(F.col("_level") == level + 1).select(
            "_group", F.lit(0).cast("long").alias("_parent"), F.col("_path").alias("_upper"), *given)
        parents = seeds if above is None else seeds.unionByName(above)
        here = (levels[level].withColumn("_parent", F.expr(f"_pos div {FANOUT}"))
                .join(parents, ["_group", "_parent"]).withColumn("_path", F.concat(own, F.col("_upper"))))
        if level == 0:
            return found.unionByName(here.select(*columns))
        above = stored(here.select("_group", F.col("_pos").alias("_parent"), F.col("_path").alias("_upper"), *given),
                       "merkle-paths")
    return found


def folded(node: Column, path: Column) -> Column:
    """The root that ``node`` leads to beside the siblings of ``path``."""
    return F.aggregate(path, node, lambda own, s: digest(s["before"], own, s["after"]))


def manifest(docs: DataFrame, values: list[str], id_col: str = "doc_id", group_col: str = "lang",
             tampered: dict[str, Column] | None = None, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, siblings, proof_sha256, folded_root, verified.

    ``values`` are the columns that a leaf covers, in order; ``tampered`` gives, by name, the values of
    columns that were changed after the manifest was taken, and ``folded_root`` is the root that the
    changed row leads to beside the original siblings. ``siblings`` holds, from the lowest level up, the
    joined digests before and after the node. ``keep`` names further columns to carry.
    """
    new = ("leaf", "subroot", "root", "siblings", "proof_sha256", "folded_root", "verified")
    keep = [c for c in others(docs, id_col, *new) if c in (keep or ())]
    original = [F.col(f"`{c}`") for c in values]
    now = [(tampered or {}).get(c, F.col(f"`{c}`")) for c in values]
    group = F.when(F.col(group_col).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(group_col)))
    hashed = docs.select(F.col(id_col).alias("_id"), *[F.col(f"`{c}`").alias(f"k_{c}") for c in keep],
                         group.alias("_group"), leaf(original).alias("_node"), leaf(now).alias("_now"),
                         F.monotonically_increasing_id().alias("_row"))
    leaves = stored(ranked(stored(hashed, "merkle-leaves"), ["_id", "_node", "_row"]), "merkle-places")
    levels, subroots = tree(leaves)
    subroots = stored(subroots, "merkle-subroots")
    # the groups' roots in the groups' order are the leaves of the upper tree
    upper = stored(ranked(subroots.select(F.lit("").alias("_group"), F.col("_group").alias("_name"),
                                          "_level", "_node"), ["_name"]), "merkle-groups")
    upper_levels, root = tree(upper)
    root = root.select("_group", "_level", F.array().cast(PATH).alias("_path"), F.col("_node").alias("_root"))
    tops = stored(paths(upper, upper_levels, root).select(
        F.col("_name").alias("_group"), "_level", "_path", F.col("_node").alias("_subroot"), "_root"), "merkle-tops")
    found = paths(leaves, levels, tops)
    siblings = F.transform("_path", lambda s: F.concat(s["before"], s["after"]))
    fold = folded(F.col("_now"), F.col("_path"))
    return found.select(
        F.col("_id").alias(id_col), *[F.col(f"k_{c}").alias(c) for c in keep], F.col("_node").alias("leaf"),
        F.col("_subroot").alias("subroot"), F.col("_root").alias("root"), F.col("_path").alias("siblings"),
        F.sha2(F.concat_ws("", siblings).cast("binary"), 256).alias("proof_sha256"), fold.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
