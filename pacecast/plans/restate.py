"""Restating stored forecast rows when realised month ends move.

A forecast row is published with its expectations and judged later: the realised month end, the
errors against it and, one month on, last month's accuracy. Closing a month again for a late fact
would compute every column of every row anew. ``restate`` takes the month ends from the current
series, compares them with those stored and writes only the days on which some row differs, plus the days one
month later that look back to them. Published figures (month-to-date values, rates,
expectations, bands) stay as they were issued; the errors are made of them by the same formulas.

What is read: the stored rows of the judged days, one month on either side, and the series' rows on
month-end days. Everything is sized by (series x days), never by the facts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_end, py_add_months, py_month_start
from ..operators.backtest import backtest_errors, lookback_accuracy
from ..operators.forecast import linear_projection
from ..operators.series import KEYS, metric_series
from ..session import materialize, remove_paths
from ..sources.commits import CommittedTable, StaleRead
from .pipeline import OUTPUT_COLUMNS, Source, _inputs
from .series_store import SeriesStore

ACCURACY = ["acc_prev_m1", "acc_prev_linear"]
ATTEMPTS = 5


def months_span(changed: dict[str, list[dt.date]] | Iterable[dt.date]) -> tuple[dt.date, dt.date] | None:
    """Whole months ``[lo, hi)`` around some days, or the changed days by fact that ``SeriesStore.sync`` gives."""
    days = [d for ds in changed.values() for d in ds] if isinstance(changed, dict) else list(changed)
    if not days:
        return None
    return py_month_start(min(days)), py_add_months(py_month_start(max(days)), 1)


def month_ends(series: DataFrame) -> DataFrame:
    """Realised month end of every series: keys, month_end, realised."""
    return (series.where(F.col("date") == month_end(F.col("date")))
            .groupBy(*KEYS, F.col("date").alias("month_end")).agg(F.max("value_ptd").alias("realised")))


def judged(stored: DataFrame, ends: DataFrame) -> DataFrame:
    """Stored rows with their realised month end, errors and straight-line errors made anew.

    A month without an end in ``ends`` is open: no realised value, no errors, rates 0.
    """
    found = ends.select(*[F.col(k).alias(f"_{k}") for k in KEYS], "month_end", "realised")
    same = [stored[k].eqNullSafe(found[f"_{k}"]) for k in KEYS]
    kind = stored.schema["eop_realised"].dataType
    rows = (stored.join(found, [month_end(stored["date"]) == found["month_end"], *same], "left")
            .withColumn("eop_realised", F.col("realised").cast(kind))
            .withColumn("days_in_month", F.dayofmonth(month_end(F.col("date")))))
    rows = linear_projection(backtest_errors(rows))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored.schema.fields])


def moved_days(stored: DataFrame, ends: DataFrame) -> list[dt.date]:
    """Days on which a stored row's realised month end differs; at most the table's days."""
    found = ends.select(*[F.col(k).alias(f"_{k}") for k in KEYS], "month_end", "realised")
    same = [stored[k].eqNullSafe(found[f"_{k}"]) for k in KEYS]
    kind = stored.schema["eop_realised"].dataType
    rows = (stored.select("date", *KEYS, "eop_realised")
            .join(found, [month_end(stored["date"]) == found["month_end"], *same], "left")
            .where(~F.col("eop_realised").eqNullSafe(F.col("realised").cast(kind))))
    return sorted(r["date"] for r in rows.select("date").distinct().collect())


def restate(spark: SparkSession, source: Source, target: CommittedTable, lo: dt.date, hi: dt.date,
            as_of: dt.date | None = None) -> list[dt.date]:
    """Bring realised values, errors and accuracy of the stored anchors ``[lo, hi)`` up to date.

    ``lo`` and ``hi`` are month starts (``months_span`` of the days that ``SeriesStore.sync`` reports).
    The days written: those whose realised value moved, and stored days one month later. All of
    them change in one commit. Days that another writer replaced meanwhile are read and
    judged again, never overwritten with older rows. Exact repeats of a stored row become one
    row; nothing is written if nothing moved, and a table never written stays so.
    """
    if lo != py_month_start(lo) or hi != py_month_start(hi):
        raise ValueError("whole months are judged: lo and hi are month starts")
    first, last = py_add_months(lo, -1), py_add_months(hi, 1)
    scratch: list[str] = []
    try:
        if isinstance(source, SeriesStore):
            series = source.series(first, as_of)
        else:
            inputs = _inputs(source, first, as_of, scratch)
            series = metric_series(spark, inputs, first, as_of)
        ends = materialize(month_ends(series), "month-ends", scratch)
        for _ in range(ATTEMPTS):
            parts = target.parts()
            stored = target.read(first, last)
            if stored is None:
                return []
            stored = stored.select(*OUTPUT_COLUMNS)
            moved = moved_days(stored.where((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi))), ends)
            if not moved:
                return []
            back = set(moved)
            days = back | {d for d in parts if py_add_months(d, -1) in back}
            sources = {d for d in parts if d in days or d in {py_add_months(x, -1) for x in days}}
            # rows outside [lo, hi) keep their errors; only what they look back to is new
            inside = (F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi))
            base = stored.where(F.col("date").isin(sorted(sources)))
            fresh = judged(base.where(inside), ends).unionByName(base.where(~inside))
            fresh = materialize(fresh, "judged-rows", scratch)
            # a row that already stands for several earlier rows is joined to them once
            rows = fresh.where(F.col("date").isin(sorted(days))).drop(*ACCURACY).distinct()
            known = {py_add_months(d, -1) for d in days} & set(parts)
            restated = lookback_accuracy(rows, fresh).select(*OUTPUT_COLUMNS)
            # a day whose earlier month was never stored keeps the accuracy it was computed with
            unknown = sorted(d for d in days if py_add_months(d, -1) not in known)
            if unknown:
                kept = fresh.where(F.col("date").isin(unknown)).select(*OUTPUT_COLUMNS).distinct()
                restated = restated.where(~F.col("date").isin(unknown)).unionByName(kept)
            try:
                return target.replace(restated, days.__contains__,
                                      expect={d: parts.get(d) for d in sources | days})
            except StaleRead:
                continue
        raise RuntimeError(f"{ATTEMPTS} times other writers replaced the same days")
    finally:
        remove_paths(spark, scratch)
