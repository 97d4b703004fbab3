"""O1 anchor spine and O2 week-start lookup.

The reference walks the anchor days one by one; every date it uses is a
function of the anchor alone, so here they are columns of a spine frame
(one row per anchor day) and the whole run is one set-based job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_end, month_start, months_back, run_window

# A spine is one row per anchor day; the role table has 11 rows (~50 bytes
# each) per anchor. Up to this many anchors (55 years of days, a role table
# of ~10 MB) they are broadcast; beyond it the join strategy is left to AQE.
MAX_BROADCAST_ANCHORS = 20_000

SPINE_COLUMNS = [
    "anchor", "period_start", "history_start", "days_in_month",
    "p1", "p2", "p3", "e0", "e1", "e2", "e3", "m1", "m2", "m3", "x1", "x2", "x3",
]


def spine_columns(anchor: Column, own_month_shift: bool = False) -> dict[str, Column]:
    """All role dates of one anchor day.

    ``pk``  same day k months back (clamped);
    ``ek``  end of month k back (``e0`` = this month's end);
    ``mk``  month-k end moved back by the days this month is shorter;
    ``xk``  days this month is longer than month k (0 if not).
    The three-month alignment re-uses the one-month shortfall unless
    ``own_month_shift`` is set (the reference never uses its own).
    """
    start = month_start(anchor)
    e = {0: month_end(anchor)}
    for k in (1, 2, 3):
        e[k] = month_end(months_back(start, k))
    diff = {k: F.dayofmonth(e[0]) - F.dayofmonth(e[k]) for k in (1, 2, 3)}
    short = {k: F.least(diff[k], F.lit(0)) for k in (1, 2, 3)}
    m3_shift = short[3] if own_month_shift else short[1]
    cols = {
        "anchor": anchor,
        "period_start": start,
        "history_start": months_back(start, 3),
        "days_in_month": F.dayofmonth(e[0]),
    }
    for k in (1, 2, 3):
        cols[f"p{k}"] = months_back(anchor, k)
    for k in (0, 1, 2, 3):
        cols[f"e{k}"] = e[k]
    cols["m1"] = F.date_add(e[1], short[1])
    cols["m2"] = F.date_add(e[2], short[2])
    cols["m3"] = F.date_add(e[3], m3_shift)
    for k in (1, 2, 3):
        cols[f"x{k}"] = F.greatest(diff[k], F.lit(0))
    return cols


def spine_for_anchors(anchors: DataFrame, anchor_col: str = "anchor",
                      own_month_shift: bool = False) -> DataFrame:
    """Spine over any frame of anchor dates (e.g. the days present in data)."""
    cols = spine_columns(F.col(anchor_col).cast("date"), own_month_shift)
    return anchors.select(*[cols[name].alias(name) for name in SPINE_COLUMNS])


def anchor_range(spark: SparkSession, lo: dt.date, hi: dt.date) -> DataFrame:
    """One row per day in ``[lo, hi)``; empty when ``hi <= lo``."""
    n = (hi - lo).days
    frame = spark.range(1).select(
        F.explode(F.sequence(F.lit(lo), F.lit(hi - dt.timedelta(days=1)))).alias("anchor"))
    return frame if n > 0 else frame.limit(0)


def calendar_spine(spark: SparkSession, base_day: str | dt.date,
                   own_month_shift: bool = False) -> DataFrame:
    """Spine of the days a run on ``base_day`` recomputes."""
    lo, hi = run_window(base_day)
    return spine_for_anchors(anchor_range(spark, lo, hi), own_month_shift=own_month_shift)


def backfill_spine(spark: SparkSession, first_base: str | dt.date, last_base: str | dt.date,
                   own_month_shift: bool = False) -> DataFrame:
    """Spine of every day that runs on ``first_base..last_base`` recompute."""
    lo, _ = run_window(first_base)
    _, hi = run_window(last_base)
    return spine_for_anchors(anchor_range(spark, lo, hi), own_month_shift=own_month_shift)


# ---------------------------------------------------------------- O2 ----------

def week_start(calendar: DataFrame, days: DataFrame | None = None,
               day_col: str = "day") -> DataFrame:
    """First calendar day of each day's week, and the same a week earlier.

    ``calendar`` has ``day`` and ``week_id``. Instead of a self-join of the
    calendar on ``week_id`` (all pairs inside a week) the week's first day
    is aggregated once per week and joined back on the key.
    """
    firsts = calendar.groupBy("week_id").agg(F.min("day").alias("week_start"))
    probe = calendar if days is None else (
        days.select(F.col(day_col).cast("date").alias("day"))
        .join(calendar.select("day", "week_id"), "day", "left"))
    return (probe.join(firsts, "week_id", "left")
            .select("day", "week_start",
                    F.date_sub("week_start", 7).alias("prev_week_start")))


def calendar_from_range(spark: SparkSession, first: Column | dt.date, last: Column | dt.date,
                        frame: DataFrame | None = None) -> DataFrame:
    """Calendar dimension (day, Monday-based week id) for a date range.

    ``first``/``last`` may be columns of a one-row ``frame`` (e.g. the min
    and max day of a table), so the calendar spans the data.
    """
    source = frame if frame is not None else spark.range(1)
    days = source.select(F.explode(F.sequence(F.lit(first) if isinstance(first, dt.date) else first,
                                              F.lit(last) if isinstance(last, dt.date) else last))
                         .alias("day"))
    monday = F.date_trunc("week", F.col("day")).cast("date")
    return days.select(
        "day",
        (F.datediff(monday, F.lit(dt.date(1970, 1, 5))) / 7).cast("int").alias("week_id"))
