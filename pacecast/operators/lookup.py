"""Month-to-date figures of every (anchor day, series) at its role dates.

Each anchor needs a series' PTD on 11 role dates (the anchor, the same day
1-3 months back, this and earlier month ends, length-aligned earlier month
ends) and the day value on 3 of them. A conditional aggregate of the
whole series against every anchor would be an anchor x series nested
loop; instead the spine is unpivoted into (anchor, role, role_date) rows,
equi-joined to the series on the date (the role table is small and its size
is known from the run parameters, so it is broadcast) and aggregated by
(anchor, series) with one ``max(when(role ...))`` per role.

A series without a row on any role date still gets a (NULL) row for every
anchor whose 3-month history window it reaches: those "alive" pairs are
added to the same aggregation as empty rows, so there is no outer join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .calendar import MAX_BROADCAST_ANCHORS
from .series import KEYS

PTD_ROLES = ["anchor", "p1", "p2", "p3", "m1", "m2", "m3", "e0", "e1", "e2", "e3"]
VALUE_ROLES = ["e1", "e2", "e3"]
CARRIED = ["anchor", "x1", "x2", "x3", "days_in_month"]


def role_dates(spine: DataFrame) -> DataFrame:
    pairs = ", ".join(f"'{r}', {r}" for r in PTD_ROLES)
    return spine.selectExpr(*CARRIED, f"stack({len(PTD_ROLES)}, {pairs}) as (role, role_date)")


def alive_pairs(series: DataFrame, spine: DataFrame, months: tuple[dt.date, dt.date],
                n_anchors: int | None = None) -> DataFrame:
    """(anchor, series) pairs where the series has a row on/after the
    anchor's history start (first day of the month three months back).

    Equi-join form: each series is expanded to the run months its last day
    reaches (at most the number of months in the run), then joined to the
    spine on the month.
    """
    first, last = months
    bound = F.least(F.lit(last), F.add_months(F.trunc("last_date", "MM"), 3))
    per_key = series.groupBy(*KEYS).agg(F.max("date").alias("last_date"))
    expanded = (per_key.filter(bound >= F.lit(first))
                .select(*KEYS, F.explode(F.sequence(F.lit(first), bound,
                                                    F.expr("interval 1 month")))
                        .alias("period_start")))
    anchors = spine.select(*CARRIED, "period_start")
    if n_anchors is not None and n_anchors <= MAX_BROADCAST_ANCHORS:
        anchors = F.broadcast(anchors)
    return expanded.join(anchors, "period_start").drop("period_start")


def run_months(spine: DataFrame) -> tuple[dt.date, dt.date]:
    """First and last anchor month of a spine (two scalars)."""
    row = spine.agg(F.min("period_start").alias("a"), F.max("period_start").alias("b")).first()
    return row["a"], row["b"]


def period_lookup(series: DataFrame, spine: DataFrame, n_anchors: int | None = None,
                  months: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """One row per (anchor, live series) with PTD ``P_<role>`` and value ``V_<role>``.

    ``n_anchors`` (known from the run parameters) gates the broadcast of the
    role table; without it the join strategy is left to AQE's runtime sizes.
    """
    if months is None:
        months = run_months(spine)
    if months[0] is None:
        months = (dt.date(1970, 1, 1), dt.date(1969, 12, 1))  # empty spine: nothing alive
    roles = role_dates(spine)
    if n_anchors is not None and n_anchors <= MAX_BROADCAST_ANCHORS:
        roles = F.broadcast(roles)
    hits = (series.join(roles, series["date"] == roles["role_date"])
            .select(*CARRIED, *KEYS, "role", "value", "value_ptd"))
    alive = alive_pairs(series, spine, months, n_anchors).select(
        *CARRIED, *KEYS, F.lit(None).cast("string").alias("role"),
        F.lit(None).cast(series.schema["value"].dataType).alias("value"),
        F.lit(None).cast(series.schema["value_ptd"].dataType).alias("value_ptd"))
    both = hits.unionByName(alive)
    aggs = [F.expr(f"max(CASE WHEN role = '{r}' THEN value_ptd END)").alias(f"P_{r}")
            for r in PTD_ROLES]
    aggs += [F.expr(f"max(CASE WHEN role = '{r}' THEN value END)").alias(f"V_{r}")
             for r in VALUE_ROLES]
    # keys: the anchor and the series; the carried columns depend on the anchor only
    out = both.groupBy(*CARRIED, *KEYS).agg(*aggs)
    return out.withColumnRenamed("anchor", "date")
