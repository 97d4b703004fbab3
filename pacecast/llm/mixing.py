"""Mixing sources to target weights by entropy balancing (operator 1), DataFrame operations only.

Every document i of source k gets a rate r_i, the number of times it is taken
in expectation. Among all rates of at most ``most`` with sum r_i size_i = target_k,
those closest to one copy each in relative entropy are exponentially tilted:
r_i = min(most, exp(lambda_k size_i / mean size_k)). The multipliers maximise a concave
dual whose gradient is the constraint's residual; they are found by Newton steps,
kept inside a bracket that the residual's sign narrows. A step needs two sums per
source, taken over the counts of documents by (source, size): windows of that table,
which the steps of a job share one exchange and one small join for.

Rates become copies by systematic rounding in the order of sizes: the running sum
of rates, rounded down, goes up by a document's copies. Documents longer than ``LONG``
times their source's mean are rounded first, and the dual is solved once more for the others
and what is left of the target. Then up to ``CORRECTIONS`` documents of a fitting size
take one copy more or less. Running
sums go over the (source, size) table and, for a size that many documents share,
over cells of about the square root of their number, so no window holds a
source or a group of copies. (The windows over all sources hold a row per source.)

A null or empty text has size 0 and is never taken; a null source is a source
of its own, after all others. Repeated rows are documents of their own; an
empty table gives an empty table. Ties are ordered by id, and which of fully
equal rows is taken makes no difference. Reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, others, stored

#: Residual of a constraint, as a share of its target, at which the Newton steps end.
TOLERANCE = 1e-6
STEPS_A_JOB, JOBS = 4, 12
CORRECTIONS = 3
SALTS = 32
LONG = 2.0
WEIGHTS = (3.0, 1.0, 2.0)
#: What the words of ``WORD`` leave of a text.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text: Column) -> Column:
    """Number of words of a text (null: 0).

    Each word becomes one letter, blanks go; ``regexp_count`` would hold a text's words as an array.
    """
    return F.coalesce(F.length(F.translate(F.regexp_replace(text, WORD, "w"), BLANKS, "")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5,
            most: float = 2.0) -> DataFrame:
    """Add ``target`` to a table (source, source_size): one row per source.

    Sources by code point, null last, take the weights in turn and divide
    ``share`` times all sizes; a target stops at ``most`` times its source's
    size, and the excess goes to the others by weight until none is above. As
    capped sources are those whose limit per weight is lowest, the final level
    follows from running sums in that order. Windows without a key hold one
    row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (place % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("_weight", weight).withColumn("_limit", F.col("source_size") * most)
    order = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everywhere) * share
    level = ((total - F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
             / F.sum("_weight").over(onward))
    leveled = ranked.withColumn("_level", level)
    # the first source whose limit lies above the level that is left for it and those after it
    final = F.min(F.when(F.col("_limit") / F.col("_weight") > F.col("_level"),
                         F.struct(F.col("_limit") / F.col("_weight"), F.col("source").isNull(),
                                  F.col("source"), F.col("_level").alias("level")))).over(everywhere)
    return (leveled.withColumn("_final", final["level"])
            .withColumn("target", F.least("_limit", F.coalesce(F.col("_weight") * F.col("_final"),
                                                               F.col("_limit"))))
            .drop("_weight", "_limit", "_level", "_final"))


def _rate(multiplier: Column, size: Column, mean: Column, most: float) -> Column:
    return F.least(F.lit(most), F.exp(F.least(multiplier * size / mean, F.lit(math.log(most) + 1))))


def multipliers(sizes: DataFrame, sources: DataFrame, most: float = 2.0) -> DataFrame:
    """Solve the dual: ``lambda`` for each source of (source_key, source_size, target, mean, smallest).

    ``sizes`` counts documents by (source_key, size > 0). Sources whose target
    is 0 or ``most`` times their size need no solving and are left out.
    """
    open_ = sources.where((F.col("target") > 0) & (F.col("target") < most * F.col("source_size") * (1 - 1e-12)))
    above = F.col("target") > F.col("source_size")
    state = open_.select(
        "source_key", "target", "mean", F.lit(0.0).alias("lambda"),
        F.when(above, 0.0).otherwise(-F.lit(1e6)).alias("_low"),
        F.when(above, math.log(most) * F.col("mean") / F.col("smallest")).otherwise(0.0).alias("_high"),
        F.lit(None).cast("double").alias("_residual"))
    limit, source = F.lit(math.log(most)), Window.partitionBy("source_key")
    for job in range(JOBS):
        # one join a job; its steps follow each other on the rows of a source, without another exchange or broadcast
        rows = sizes.select("source_key", "size", "n").join(state, "source_key")
        for _ in range(STEPS_A_JOB):
            tilt = F.col("lambda") * F.col("size") / F.col("mean")
            mass = F.col("n") * F.col("size") * _rate(F.col("lambda"), F.col("size"), F.col("mean"), most)
            sums = rows.withColumns({
                "_mass": F.sum(mass).over(source),
                "_slope": F.sum(F.when(tilt < limit, mass * F.col("size") / F.col("mean"))).over(source)})
            gap = F.col("_mass") - F.col("target")
            low = F.when(gap < 0, F.greatest("_low", "lambda")).otherwise(F.col("_low"))
            high = F.when(gap > 0, F.least("_high", "lambda")).otherwise(F.col("_high"))
            newton = F.col("lambda") - gap / F.col("_slope")
            inside = (newton >= low) & (newton <= high)
            done = F.abs(gap) <= TOLERANCE * F.col("target")
            rows = sums.select(
                "source_key", "size", "n", "target", "mean",
                F.when(done, F.col("lambda")).when(inside, newton).otherwise((low + high) / 2)
                .alias("lambda"), low.alias("_low"), high.alias("_high"),
                (F.abs(gap) / F.col("target")).alias("_residual"))
        # all rows of a source hold the same values
        state = stored(rows.groupBy("source_key").agg(
            *[F.max(c).alias(c) for c in ("target", "mean", "lambda", "_low", "_high", "_residual")]), "mixing-state")
        if (state.agg(F.max("_residual")).first()[0] or 0.0) <= TOLERANCE:
            break
    # sums of doubles depend on the order of rows in their last digits; the multiplier used doesn't
    return state.select("source_key", F.round("lambda", 12).alias("lambda"))


def _rounded(rates: Column) -> Column:
    """Copies up to a running sum of rates; half a copy ahead, so that no end is at a disadvantage."""
    return F.floor(rates + F.lit(0.5 + 1e-9))


def _starts(sizes: DataFrame, solved: DataFrame, most: float) -> DataFrame:
    """Add rate, _start (running sum of rates before a size, long documents apart) and _all (its copies).

    ``sizes``: (source_key, size, n, long, target, mean, ...), ``solved``: (source_key, lambda).
    """
    rate = (F.when((F.col("target") <= 0) | (F.col("size") == 0), 0.0)
            .when(F.col("lambda").isNull(), most)
            .otherwise(_rate(F.col("lambda"), F.col("size"), F.col("mean"), most)))
    before = (Window.partitionBy("source_key", "long").orderBy("size")
              .rowsBetween(Window.unboundedPreceding, -1))
    start = F.coalesce(F.sum(F.col("n") * F.col("rate")).over(before), F.lit(0.0))
    return (sizes.join(solved, "source_key", "left").withColumn("rate", rate).withColumn("_start", start)
            .withColumn("_all", _rounded(F.col("_start") + F.col("n") * F.col("rate")) - _rounded(F.col("_start"))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0,
        keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``keep`` columns, size, source, source_size, target, rate, copies, taken.

    An old column (``keep``: default the id) with a new one's name gives way to it.
    """
    new = ("size", "mix_source", "source_size", "target", "rate", "copies", "taken")
    keep = [c for c in others(docs, *new) if c in ([id_col] if keep is None else keep)]
    # a null source gets a key of its own, distinct from every name
    key = F.when(F.col(source_col).isNull(), "0").otherwise(F.concat(F.lit("1"), source_col))
    docs = stored(docs.select(
        *[F.col(f"`{c}`").alias(f"k_{c}") for c in keep], F.col(id_col).cast("string").alias("_id"),
        F.xxhash64(text_col).alias("_text"), key.alias("source_key"), words(F.col(text_col)).alias("size")),
        "mixing-docs")
    sizes = stored(docs.groupBy("source_key", "size").agg(F.count("*").alias("n")), "mixing-sizes")
    per_source = sizes.groupBy("source_key").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("smallest"))
    named = per_source.withColumn("source", F.when(F.col("source_key") != "0",
                                                   F.substring("source_key", 2, 1 << 30)))
    sources = stored(targets(named, weights, share, most).drop("source"), "mixing-sources")
    # the rounding of long documents is made up for by the others: these are solved again for what is left
    marked = sizes.join(sources, "source_key").withColumn("long", F.col("size") > LONG * F.col("mean"))
    rounded_long = _starts(marked, multipliers(sizes.where("size > 0"), sources, most), most).where("long")
    spent = rounded_long.groupBy("source_key").agg(F.sum(F.col("_all") * F.col("size")).alias("_spent"))
    rest = marked.where("not long and size > 0").groupBy("source_key").agg(
        F.first("target").alias("_target"), F.sum(F.col("n") * F.col("size")).alias("source_size"),
        (F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean"), F.min("size").alias("smallest"))
    rest = stored(rest.join(spent, "source_key", "left").withColumn("target", F.greatest(F.lit(0.0), F.least(
        F.col("_target") - F.coalesce("_spent", F.lit(0)), most * F.col("source_size")))).drop("_target", "_spent"),
        "mixing-rest")
    short = marked.where("not long and size > 0").select("source_key", "size", "n")
    rounded_short = _starts(short.join(rest, "source_key").withColumn("long", F.lit(False)),
                            multipliers(short, rest, most), most)
    common = ["source_key", "size", "rate", "_start"]
    starts = stored(rounded_long.select(*common).unionByName(rounded_short.select(*common)), "mixing-starts")
    starts = (marked.select("source_key", "size", "source_size", "target").join(starts, ["source_key", "size"], "left")
              .fillna(0.0, ["rate", "_start"]))
    # documents of one size: cells by hash, their number growing as the square root of the documents'
    cells = sizes.select("source_key", "size", F.ceil(F.sqrt("n")).alias("_cells"))
    # a size that a third of all documents share is dealt over SALTS tasks here, over its cells from then on
    salted = docs.withColumn("_salt", F.pmod(F.xxhash64("_text", "_id"), F.lit(SALTS)))
    cells = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    # a merge join: the cells grow with the sources and sizes, and are not for broadcasting
    placed = salted.join(cells.hint("merge"), ["source_key", "size", "_salt"]).drop("_salt").withColumn(
        "_cell", F.pmod(F.xxhash64("_id", "_text"), F.col("_cells")))
    by_cell = placed.groupBy("source_key", "size", "_cell").agg(F.count("*").alias("n"))
    to_cell = (Window.partitionBy("source_key", "size").orderBy("_cell")
               .rowsBetween(Window.unboundedPreceding, -1))
    cell_starts = (by_cell.join(starts, ["source_key", "size"])
                   .withColumn("_start", F.col("_start") + F.col("rate")
                               * F.coalesce(F.sum("n").over(to_cell), F.lit(0))).drop("n"))
    rank = F.row_number().over(Window.partitionBy("source_key", "size", "_cell").orderBy("_id", "_text"))
    taken = placed.drop("_cells").join(cell_starts, ["source_key", "size", "_cell"]).withColumn("_rank", rank)

    def rounded(k: Column) -> Column:
        return _rounded(F.col("_start") + F.col("rate") * k)

    copies = F.least(rounded(F.col("_rank")) - rounded(F.col("_rank") - 1),
                     F.lit(int(most))).cast("long")
    taken = stored(taken.withColumn("copies", F.when(F.col("rate") > 0, copies).otherwise(F.lit(0)))
                   .drop("_start"), "mixing-copies")
    flips = _corrections(taken, int(most))
    own = F.filter("_flips", lambda f: (f["size"] == F.col("size")) & (f["cell"] == F.col("_cell"))
                   & (f["rank"] == F.col("_rank")))
    fixed = taken.join(flips, "source_key").withColumn(
        "copies", F.col("copies") + F.when(F.size(own) > 0, own[0]["change"]).otherwise(F.lit(0)))
    return fixed.select(
        *[F.col(f"`k_{c}`").alias(c) for c in keep], "size",
        F.when(F.col("source_key") != "0", F.substring("source_key", 2, 1 << 30)).alias("mix_source"),
        "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _corrections(taken: DataFrame, most: int) -> DataFrame:
    """Per source, up to ``CORRECTIONS`` documents whose copies change by one.

    Each is the one whose size comes nearest to what the source still lacks or
    has in excess, if that brings it nearer: (source_key, _flips).
    """
    flip = "array<struct<size:bigint,cell:bigint,rank:int,change:bigint>>"
    state = taken.groupBy("source_key").agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("_gap"),
    ).withColumn("_flips", F.array().cast(flip))
    for _ in range(CORRECTIONS):
        state = stored(state, "mixing-gaps")
        change = F.when(F.col("_gap") > 0, 1).otherwise(-1).cast("long")
        after = F.col("copies") + F.when(F.col("_gap") > 0, 1).otherwise(-1)
        known = F.exists("_flips", lambda f: (f["size"] == F.col("size")) & (f["cell"] == F.col("_cell"))
                         & (f["rank"] == F.col("_rank")))
        near = F.abs(F.col("size") - F.abs("_gap"))
        best = (taken.join(state, "source_key")
                .where((F.col("rate") > 0) & after.between(0, most) & (near < F.abs("_gap")) & ~known)
                .groupBy("source_key")
                .agg(F.min(F.struct(near.alias("near"), "size", "_cell", "_rank")).alias("_best")))
        add = F.struct(F.col("_best.size").alias("size"), F.col("_best._cell").alias("cell"),
                       F.col("_best._rank").alias("rank"), change.alias("change"))
        found = F.col("_best").isNotNull()
        state = state.join(best, "source_key", "left").select(
            "source_key",
            F.when(found, F.col("_gap") - change * F.col("_best.size")).otherwise(F.col("_gap")).alias("_gap"),
            F.when(found, F.array_append("_flips", add)).otherwise(F.col("_flips")).cast(flip).alias("_flips"))
    return stored(state, "mixing-gaps").select("source_key", "_flips")
