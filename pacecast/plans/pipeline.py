"""A daily run, a month close and a backfill, each one set-based job.

``run_day(base)`` recomputes yesterday, or on the 1st the whole previous
month (realised month ends are known then). ``backfill(first, last)`` does
what the runs on ``first..last`` would do in one job: the series is built
once for the whole history, every anchor day is a spine row, and last
month's accuracy comes from one self-join of the computed rows (it reads
only columns that never depend on the look-back itself, so no recursion).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date, py_add_months, py_month_start, run_window
from ..operators.backtest import backtest_errors, lookback_accuracy
from ..operators.calendar import anchor_range, spine_for_anchors
from ..operators.forecast import dispersion_bands, linear_projection, pace_forecast
from ..operators.lookup import period_lookup
from ..operators.series import KEYS, metric_series
from ..sources.commits import CommittedTable
from ..sources.shipping import one_pass_inputs
from ..sources.standins import Inputs
from ..sources.store import read_output, write_slice
from ..session import materialize, remove_paths
from ..sources.tables import TableSet
from .series_store import SeriesStore

OUTPUT_COLUMNS = [
    "date", *KEYS,
    "ptd", "ptd_m1", "eop_adj_m1", "rate_m1", "exp_m1", "eop_realised", "eop_m1",
    "eop_adj_m2", "rate_m2", "exp_m2", "eop_m2",
    "ptd_m3", "eop_adj_m3", "rate_m3", "exp_m3", "eop_m3",
    "exp_mean", "exp_std",
    "exp_m1_lo", "exp_m1_hi", "exp_m2_lo", "exp_m2_hi",
    "exp_m3_lo", "exp_m3_hi", "exp_mean_lo", "exp_mean_hi",
    "err_m1", "err_rate_m1", "err_m2", "err_rate_m2", "err_m3", "err_rate_m3",
    "acc_prev_m1",
    "linear_exp", "linear_err", "linear_err_rate", "acc_prev_linear",
]
PRE_LOOKBACK = [c for c in OUTPUT_COLUMNS if c not in ("acc_prev_m1", "acc_prev_linear")]


def history_start(lo: dt.date) -> dt.date:
    """Earliest day any anchor from ``lo`` on reads: month start three months back."""
    return py_add_months(py_month_start(lo), -3)


def forecast_frame(series: DataFrame, spine: DataFrame, n_anchors: int | None = None,
                   months: tuple[dt.date, dt.date] | None = None) -> DataFrame:
    """Lookups, expectations, spread, errors and the straight line (41 columns)."""
    frame = period_lookup(series, spine, n_anchors, months)
    frame = pace_forecast(frame)
    frame = dispersion_bands(frame)
    frame = backtest_errors(frame)
    frame = linear_projection(frame)
    return frame.select(*PRE_LOOKBACK)


def anchor_ranges(lo: dt.date, hi: dt.date, with_previous: bool) -> list[tuple[dt.date, dt.date]]:
    """Day ranges ``[a, b)`` to compute: the anchors, plus (for in-job
    history) the days one month before them - a contiguous range since
    ``add_months`` is monotone; merged with the anchors when they touch."""
    if not with_previous:
        return [(lo, hi)]
    prev_lo = py_add_months(lo, -1)
    prev_hi = py_add_months(hi - dt.timedelta(days=1), -1) + dt.timedelta(days=1)
    if prev_hi >= lo:
        return [(prev_lo, hi)]
    return [(prev_lo, prev_hi), (lo, hi)]


def _prev_range(lo: dt.date, hi: dt.date) -> tuple[dt.date, dt.date]:
    return py_add_months(lo, -1), py_add_months(hi - dt.timedelta(days=1), -1)


def forecast_days(spark: SparkSession, inputs: Inputs | SeriesStore, lo: dt.date, hi: dt.date,
                  history: DataFrame | str | None = "self",
                  own_month_shift: bool = False, as_of: dt.date | None = None,
                  scratch: list[str] | None = None) -> DataFrame:
    """The 43-column rows of the anchor days ``[lo, hi)``.

    ``history``: ``"self"`` computes the previous month in the same job,
    a DataFrame (e.g. the stored table) is read for it, ``None`` leaves
    last month's accuracy NULL. ``as_of`` ignores series days from it on
    (the default, like the reference, has no upper bound). Paths of the
    intermediate tables written to the shared folder are appended to
    ``scratch`` (the caller removes them once the result is stored).
    """
    self_history = isinstance(history, str) and history == "self"
    ranges = anchor_ranges(lo, hi, self_history)
    first = ranges[0][0]
    if isinstance(inputs, SeriesStore):
        series = inputs.series(history_start(first), as_of)
    else:
        series = materialize(metric_series(spark, inputs, history_start(first), as_of),
                             "daily-series", scratch)
    n = sum((b - a).days for a, b in ranges)
    anchors = anchor_range(spark, *ranges[0])
    for a, b in ranges[1:]:
        anchors = anchors.unionByName(anchor_range(spark, a, b))
    spine = spine_for_anchors(anchors, own_month_shift=own_month_shift)
    months = (py_month_start(first), py_month_start(hi - dt.timedelta(days=1)))
    frame = forecast_frame(series, spine, n, months)
    if self_history:
        frame = materialize(frame, "forecast-frame", scratch)
    prev_range = _prev_range(lo, hi)
    out = lookback_accuracy(frame, frame if self_history else history, prev_range)
    return (out.filter((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)))
            .select(*OUTPUT_COLUMNS))


#: Where a run's figures come from: test tables (stand-in facts), metric facts, or their stored daily series.
Source = TableSet | Inputs | SeriesStore


def _inputs(source: Source, since: dt.date, until: dt.date | None,
            scratch: list[str] | None = None) -> Inputs | SeriesStore:
    """The facts or series themselves, or stand-ins built from the test tables (lineitem read once)."""
    return one_pass_inputs(source, since, until, scratch) if isinstance(source, TableSet) else source


def run_day(spark: SparkSession, source: Source, base_day: str | dt.date,
            target: str | CommittedTable | None = None, own_month_shift: bool = False,
            as_of: str | dt.date | None = None) -> DataFrame:
    """What the daily procedure does for ``base_day``, on metric facts or stand-ins.

    With ``target`` the slice is written to that table (reading last month's
    rows from it) and the stored slice is returned; without, the rows are
    returned and last month is computed in the same job. A path is a plain Parquet table, a
    ``CommittedTable`` swaps the slice in one step.
    """
    lo, hi = run_window(base_day)
    as_of = as_date(as_of) if as_of is not None else None
    if target is None:
        inputs = _inputs(source, history_start(py_add_months(lo, -1)), as_of)
        return forecast_days(spark, inputs, lo, hi, "self", own_month_shift, as_of)
    stored = _history(spark, target, lo, hi)
    return _written(spark, target, lo, hi, lambda scratch: forecast_days(
        spark, _inputs(source, history_start(lo), as_of, scratch), lo, hi, stored, own_month_shift, as_of, scratch))


def _history(spark: SparkSession, target: str | CommittedTable, lo: dt.date, hi: dt.date) -> DataFrame | None:
    """The stored rows that the anchors ``[lo, hi)`` look back to."""
    if not isinstance(target, CommittedTable):
        return read_output(spark, target, OUTPUT_COLUMNS)
    first, last = _prev_range(lo, hi)
    return target.read(first, last + dt.timedelta(days=1))


def _written(spark: SparkSession, target: str | CommittedTable, lo: dt.date, hi: dt.date,
             rows_of: Callable[[list[str]], DataFrame], done: str | None = None) -> DataFrame:
    """Write the slice that ``rows_of`` (given a list for scratch paths) makes; the stored slice."""
    scratch: list[str] = []
    try:
        rows = rows_of(scratch)
        if isinstance(target, CommittedTable):
            target.replace_days(rows, lo, hi, OUTPUT_COLUMNS, done)
        else:
            write_slice(rows, target, lo, hi, OUTPUT_COLUMNS)
        return stored_slice(spark, target, lo, hi, rows)
    finally:
        remove_paths(spark, scratch)


def stored_slice(spark: SparkSession, target: str | CommittedTable, lo: dt.date, hi: dt.date,
                 like: DataFrame) -> DataFrame:
    """The stored rows of ``[lo, hi)`` (an empty frame shaped like ``like``)."""
    if isinstance(target, CommittedTable):
        stored = target.read(lo, hi)
        return spark.createDataFrame([], like.schema) if stored is None else stored.select(*OUTPUT_COLUMNS)
    stored = read_output(spark, target, OUTPUT_COLUMNS)
    if stored is None:
        return spark.createDataFrame([], like.schema)
    return stored.filter((F.col("date") >= F.lit(lo)) & (F.col("date") < F.lit(hi)))


def backfill(spark: SparkSession, source: Source, first_base: str | dt.date,
             last_base: str | dt.date, target: str | CommittedTable | None = None,
             own_month_shift: bool = False, as_of: str | dt.date | None = None) -> DataFrame:
    """All days the runs on ``first_base..last_base`` recompute, in one job."""
    lo, _ = run_window(first_base)
    _, hi = run_window(last_base)
    as_of = as_date(as_of) if as_of is not None else None

    def rows(scratch: list[str] | None) -> DataFrame:
        inputs = _inputs(source, history_start(py_add_months(lo, -1)), as_of, scratch)
        return forecast_days(spark, inputs, lo, hi, "self", own_month_shift, as_of, scratch)

    return rows(None) if target is None else _written(spark, target, lo, hi, rows)


def _pieces(lo: dt.date, hi: dt.date, months: int) -> list[tuple[dt.date, dt.date]]:
    """``[lo, hi)`` cut at every ``months``-th month start after the first."""
    out, at = [], lo
    while at < hi:
        end = min(hi, py_add_months(py_month_start(at), months))
        out.append((at, end))
        at = end
    return out


def backfill_in_pieces(spark: SparkSession, source: Source, first_base: str | dt.date,
                       last_base: str | dt.date, target: CommittedTable, run: str, months: int = 1,
                       own_month_shift: bool = False, as_of: str | dt.date | None = None) -> DataFrame:
    """:func:`backfill` by pieces of whole months, each finished piece noted beside its rows.

    A piece's rows and its ledger entry are one commit, so a backfill that broke off goes on
    with the first piece that its ``run`` (any name) has not finished; a new name does all pieces anew. The first
    piece computes the month before it in the same job, later ones read it from the table (the
    columns they read don't depend on the look-back). Stand-ins are built once for all pieces left.
    """
    lo, _ = run_window(first_base)
    _, hi = run_window(last_base)
    as_of = as_date(as_of) if as_of is not None else None
    finished = set(target.ledger())
    shared: list[str] = []
    inputs = None
    try:
        for a, b in _pieces(lo, hi, months):
            name = f"{run} [{a}, {b}) as_of={as_of} own_month_shift={own_month_shift}"
            if name in finished:
                continue
            first = a == lo
            if inputs is None:  # of the earliest piece left, which reads furthest back
                inputs = _inputs(source, history_start(py_add_months(a, -1) if first else a), as_of, shared)
            history = "self" if first else _history(spark, target, a, b)
            _written(spark, target, a, b, lambda scratch, a=a, b=b, h=history: forecast_days(
                spark, inputs, a, b, h, own_month_shift, as_of, scratch), done=name)
    finally:
        remove_paths(spark, shared)
    return target.read(lo, hi).select(*OUTPUT_COLUMNS)
