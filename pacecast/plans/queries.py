"""Named queries over the test tables, one or more per operator.

Every query reads whole tables from a scale-factor folder (no id subsets
or row caps); base days are run parameters. Each returns a DataFrame with
aliased, fixed-type columns so an SQL oracle can be compared column by
column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import py_add_months, py_month_start, run_window
from ..functions.decimals import MONEY, SERIES_PTD, SERIES_VALUE, money
from ..operators.calendar import calendar_from_range, spine_for_anchors, week_start
from ..operators.lookup import CARRIED, PTD_ROLES, VALUE_ROLES, period_lookup
from ..operators.series import (CARD_PAIRS, CODED_METRICS, CUBE_SLICES, FEE_METRIC, KEYS,
                                coded_series, cube_slice_series, hourly_peak_series,
                                metric_series, month_to_date, pair_total_series,
                                row_fee_series)
from ..session import materialize, remove_paths, scratch_path
from ..sources import standins
from ..sources.commits import CommittedTable
from ..sources.contract import check_facts
from ..sources.shipping import one_pass_inputs
from ..sources.store import read_output, write_slice
from ..sources.tables import TableSet
from .pipeline import OUTPUT_COLUMNS, backfill, backfill_in_pieces, forecast_days, history_start, run_day
from .restate import months_span, restate
from .series_store import FactFolder, SeriesStore

# Base days: closes of February, March and September 1998, and a mid-month day.
BASES = {"feb": "1998-03-01", "mar": "1998-04-01", "sep": "1998-10-01", "mid": "1998-04-15"}
EVENTS_CLOSE = "2024-02-01"

KEY_COLS = ["date", *KEYS]
COLUMN_SETS = {
    "rates": KEY_COLS + ["eop_adj_m1", "rate_m1", "eop_adj_m2", "rate_m2", "eop_adj_m3", "rate_m3"],
    "expected": KEY_COLS + ["ptd", "ptd_m1", "ptd_m3", "exp_m1", "exp_m2", "exp_m3", "exp_mean"],
    "bands": KEY_COLS + ["exp_mean", "exp_std", "exp_m1_lo", "exp_m1_hi", "exp_m2_lo", "exp_m2_hi",
                         "exp_m3_lo", "exp_m3_hi", "exp_mean_lo", "exp_mean_hi"],
    "errors": KEY_COLS + ["eop_realised", "err_m1", "err_rate_m1", "err_m2", "err_rate_m2",
                          "err_m3", "err_rate_m3"],
    "linear": KEY_COLS + ["ptd", "eop_realised", "linear_exp", "linear_err", "linear_err_rate"],
    "lookback": KEY_COLS + ["err_rate_m1", "linear_err_rate", "acc_prev_m1", "acc_prev_linear"],
    "all": OUTPUT_COLUMNS,
}


def _tables(spark: SparkSession, sf_dir: str) -> TableSet:
    return TableSet(spark, sf_dir)


# ------------------------------------------------------------ calendar -------

def spine_data_days(spark: SparkSession, sf_dir: str, own_month_shift: bool = False) -> DataFrame:
    """O1 over every ship day in lineitem."""
    days = _tables(spark, sf_dir).lineitem.select(F.to_date("l_shipdate").alias("anchor")).distinct()
    return spine_for_anchors(days, own_month_shift=own_month_shift)


def week_start_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: calendar spanning lineitem's ship days; week start of every order day."""
    li = _tables(spark, sf_dir).lineitem
    bounds = li.agg(F.min(F.to_date("l_shipdate")).alias("lo"),
                    F.max(F.to_date("l_shipdate")).alias("hi"))
    cal = calendar_from_range(spark, F.col("lo"), F.col("hi"), bounds)
    orders = _tables(spark, sf_dir).orders.select(F.to_date("o_orderdate").alias("day")).distinct()
    return week_start(cal, orders)


# ------------------------------------------------------------- series --------

def _series_types(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, "date", F.col("value").cast(SERIES_VALUE).alias("value"),
                     F.col("value_ptd").cast(SERIES_PTD).alias("value_ptd"))


def mtd_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 on lineitem rows by return flag: ship timestamps tie within a day."""
    li = _tables(spark, sf_dir).lineitem.select(
        "l_returnflag", "l_shipdate", money("l_extendedprice").alias("price"))
    return _series_types(month_to_date(li, ["l_returnflag"], "l_shipdate", "price"), ["l_returnflag"])


def mtd_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 on orders by priority: up to 16 orders share a timestamp (peers)."""
    o = _tables(spark, sf_dir).orders.select(
        "o_orderpriority", "o_orderdate", money("o_totalprice").alias("price"))
    return _series_types(month_to_date(o, ["o_orderpriority"], "o_orderdate", "price"),
                         ["o_orderpriority"])


def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar dimension (day, Monday-based week id) over lineitem's ship days."""
    li = _tables(spark, sf_dir).lineitem
    bounds = li.agg(F.min(F.to_date("l_shipdate")).alias("lo"),
                    F.max(F.to_date("l_shipdate")).alias("hi"))
    return calendar_from_range(spark, F.col("lo"), F.col("hi"), bounds)


def fee_rows(spark, sf_dir):
    return standins.fee_rows(_tables(spark, sf_dir).orders)


def card_daily(spark, sf_dir):
    return standins.card_daily(_tables(spark, sf_dir).lineitem)


def entry_type_daily(spark, sf_dir):
    return standins.entry_type_daily(_tables(spark, sf_dir).lineitem)


def acceptor_cube(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return standins.acceptor_cube(t.lineitem, t.orders, t.customer, t.supplier, full=True)


def hourly_cube(spark, sf_dir):
    return standins.hourly_cube(_tables(spark, sf_dir).events, full=True)


def pair_totals(spark, sf_dir):
    return pair_total_series(standins.card_daily(_tables(spark, sf_dir).lineitem), CARD_PAIRS)


def coded(spark, sf_dir):
    return coded_series(spark, standins.entry_type_daily(_tables(spark, sf_dir).lineitem),
                        CODED_METRICS)


def row_fee(spark, sf_dir):
    return row_fee_series(standins.fee_rows(_tables(spark, sf_dir).orders), *FEE_METRIC)


def row_fee_fine(spark, sf_dir):
    """B5/W3 on fees of four decimals: summed as they are, cast at the end."""
    fees = _tables(spark, sf_dir).orders.select(
        F.col("o_orderdate").alias("created_at"),
        (money("o_totalprice") * F.lit(Decimal("0.01"))).cast("decimal(20,4)").alias("fee"))
    return row_fee_series(fees, *FEE_METRIC)


def cube_slices(spark, sf_dir):
    t = _tables(spark, sf_dir)
    cube = standins.acceptor_cube(t.lineitem, t.orders, t.customer, t.supplier, full=True)
    return cube_slice_series(spark, cube, CUBE_SLICES)


def hourly_peaks(spark, sf_dir):
    return hourly_peak_series(standins.hourly_cube(_tables(spark, sf_dir).events, full=True))


def metric_series_all(spark, sf_dir):
    return metric_series(spark, one_pass_inputs(_tables(spark, sf_dir)))


# ------------------------------------------------------------- lookups -------

def _lookup(spark: SparkSession, sf_dir: str, base_day: str, only_hourly: bool = False) -> DataFrame:
    lo, hi = run_window(base_day)
    since = history_start(lo)
    t = _tables(spark, sf_dir)
    if only_hourly:
        series = hourly_peak_series(standins.hourly_cube(t.events, since, full=False), since)
    else:
        series = metric_series(spark, one_pass_inputs(t, since), since)
    # read twice below (role join and alive pairs): computed once
    series = materialize(series, "daily-series")
    spine = spine_for_anchors(
        spark.range(1).select(F.explode(F.sequence(F.lit(lo), F.lit(hi - dt.timedelta(days=1))))
                              .alias("anchor")))
    look = period_lookup(series, spine, (hi - lo).days, (py_month_start(lo), py_month_start(lo)))
    cols = (["date"] + CARRIED[1:] + KEYS + [f"P_{r}" for r in PTD_ROLES]
            + [f"V_{r}" for r in VALUE_ROLES])
    return look.select(*cols)


# ------------------------------------------------------------ forecast -------

def _run(base_key: str, columns: str, own_month_shift: bool = False):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = run_day(spark, _tables(spark, sf_dir), BASES[base_key],
                     own_month_shift=own_month_shift)
        return df.select(*COLUMN_SETS[columns])
    return query


def _inputs_from(spark: SparkSession, sf_dir: str, first: dt.date) -> standins.Inputs:
    """Inputs of several runs on the same tables, built once; ``first``: the earliest anchor day computed."""
    return one_pass_inputs(_tables(spark, sf_dir), history_start(first))


def slice_rewrite_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the March close twice into a fresh table; the stored rows."""
    target = scratch_path(spark, "forecast-table")
    inputs = _inputs_from(spark, sf_dir, run_window(BASES["mar"])[0])
    run_day(spark, inputs, BASES["mar"], target=target)
    return run_day(spark, inputs, BASES["mar"], target=target).select(*OUTPUT_COLUMNS)


def close_two_months_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The February close, then the March close, into one table; its rows.

    March's accuracy columns come from the stored February.
    """
    target = scratch_path(spark, "forecast-table")
    inputs = _inputs_from(spark, sf_dir, run_window(BASES["feb"])[0])
    run_day(spark, inputs, BASES["feb"], target=target)
    run_day(spark, inputs, BASES["mar"], target=target)
    return read_output(spark, target, OUTPUT_COLUMNS)


def slice_rewrite_drops_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: the March close, then its slice again without the 10th; the stored rows."""
    target = scratch_path(spark, "forecast-table")
    lo, hi = run_window(BASES["mar"])
    rows = run_day(spark, _tables(spark, sf_dir), BASES["mar"], target=target)
    rest = rows.where(F.col("date") != F.lit(dt.date(1998, 3, 10)))
    write_slice(rest, target, lo, hi, OUTPUT_COLUMNS)
    return read_output(spark, target, OUTPUT_COLUMNS)


def close_month_from_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O16 on facts: the stand-ins (with full cubes) stored as facts, read as such, and closed."""
    folder = scratch_path(spark, "facts")
    lo, _ = run_window(BASES["mar"])
    since = history_start(py_add_months(lo, -1))
    scratch: list[str] = []
    standins.write_facts(standins.standin_inputs(_tables(spark, sf_dir), since, full_cubes=True, scratch=scratch), folder)
    remove_paths(spark, scratch)
    return run_day(spark, standins.read_facts(spark, folder), BASES["mar"]).select(*OUTPUT_COLUMNS)


#: Late rows of ``run_day_late_rows``: a day whose fees arrive twice, a day with a second report row.
LATE_FEES, LATE_REPORT = dt.date(1998, 4, 3), dt.date(1998, 2, 17)


def _stored_facts(spark: SparkSession, sf_dir: str, base_day: str) -> FactFolder:
    """Stand-in facts of a run's history, stored as tables."""
    folder = scratch_path(spark, "facts")
    since = history_start(py_add_months(run_window(base_day)[0], -1))
    standins.write_facts(one_pass_inputs(_tables(spark, sf_dir), since), folder)
    return FactFolder(spark, folder)


def _append(facts: FactFolder, rows: DataFrame, name: str, day: dt.date) -> None:
    writer = rows.write.mode("append")
    if facts.by_day(name):
        writer = rows.withColumn("date", F.lit(day)).write.mode("append").partitionBy("date")
    writer.parquet(f"{facts.folder}/{name}")


def add_late_fees(facts: FactFolder, first: dt.date, last: dt.date) -> None:
    """Append the fees of the days ``first..last`` once more; those of several days are booked on the last."""
    fees = facts.read("fee_rows", [(first, last + dt.timedelta(days=1))])
    if first < last:
        fees = fees.withColumn("created_at", F.lit(last).cast(fees.schema["created_at"].dataType))
    _append(facts, materialize(fees, "late-fees"), "fee_rows", last)


def add_late_rows(facts: FactFolder) -> None:
    """Append the late rows to the facts."""
    add_late_fees(facts, LATE_FEES, LATE_FEES)
    _append(facts, facts.spark.range(1).select(
        F.lit(LATE_REPORT).alias("date"), F.lit(100).cast(MONEY).alias("online_volume"),
        F.lit(None).cast(MONEY).alias("offline_volume"), F.lit(1).cast(MONEY).alias("online_count"),
        F.lit(None).cast(MONEY).alias("offline_count")), "card_daily", LATE_REPORT)


def run_day_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O16 on the stored daily series: the mid-April run of ``run_day_mid_all``."""
    facts = _stored_facts(spark, sf_dir, BASES["mid"])
    store = SeriesStore(spark, scratch_path(spark, "series"))
    store.sync(facts)
    return run_day(spark, store, BASES["mid"])


def run_day_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after late rows; the store recomputes their two days only."""
    facts = _stored_facts(spark, sf_dir, BASES["mid"])
    store = SeriesStore(spark, scratch_path(spark, "series"))
    store.sync(facts)
    add_late_rows(facts)
    store.sync(facts)
    return run_day(spark, store, BASES["mid"])


def committed_rewrite_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The March close twice into a table of atomic commits, old folders removed; its rows."""
    target = CommittedTable(spark, scratch_path(spark, "forecast-commits"))
    inputs = _inputs_from(spark, sf_dir, run_window(BASES["mar"])[0])
    run_day(spark, inputs, BASES["mar"], target=target)
    run_day(spark, inputs, BASES["mar"], target=target)
    target.vacuum(keep=1)
    return target.read().select(*OUTPUT_COLUMNS)


def committed_two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The February, then the March close into a table of atomic commits; its rows."""
    target = CommittedTable(spark, scratch_path(spark, "forecast-commits"))
    inputs = _inputs_from(spark, sf_dir, run_window(BASES["feb"])[0])
    run_day(spark, inputs, BASES["feb"], target=target)
    run_day(spark, inputs, BASES["mar"], target=target)
    return target.read().select(*OUTPUT_COLUMNS)


def backfill_pieces_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backfill over February and March by months that goes on after its first piece."""
    target = CommittedTable(spark, scratch_path(spark, "forecast-commits"))
    # the first piece computes the month before it, too
    inputs = _inputs_from(spark, sf_dir, py_add_months(run_window(BASES["feb"])[0], -1))
    backfill_in_pieces(spark, inputs, BASES["feb"], BASES["feb"], target, run="q1")
    return backfill_in_pieces(spark, inputs, BASES["feb"], BASES["mar"], target, run="q1")


#: The month end of the restating queries.
LATE_END = dt.date(1998, 3, 31)


def restated_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """March stored while it was open, and an April day that looks back to it; once
    both months have ended the rows are judged, not computed again. All rows of the table."""
    target = CommittedTable(spark, scratch_path(spark, "forecast-commits"))
    # the backfill computes the month before March, too
    inputs = _inputs_from(spark, sf_dir, dt.date(1998, 2, 1))
    backfill(spark, inputs, "1998-03-02", "1998-03-31", target=target, as_of=LATE_END)
    run_day(spark, inputs, BASES["mid"], target=target, as_of=BASES["mid"])
    restate(spark, inputs, target, dt.date(1998, 3, 1), dt.date(1998, 5, 1))
    return target.read().select(*OUTPUT_COLUMNS)


def restated_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The March close from stored series, then March's fees once more on its last day;
    errors of the days before it."""
    facts = _stored_facts(spark, sf_dir, BASES["mar"])
    store = SeriesStore(spark, scratch_path(spark, "series"))
    store.sync(facts)
    target = CommittedTable(spark, scratch_path(spark, "forecast-commits"))
    run_day(spark, store, BASES["mar"], target=target)
    add_late_fees(facts, dt.date(1998, 3, 1), LATE_END)
    changed = store.sync(facts)
    if changed:
        restate(spark, store, target, *months_span(changed))
    return target.read().where(F.col("date") < F.lit(LATE_END)).select(*COLUMN_SETS["errors"])


def _facts_with_bad_rows(spark: SparkSession, sf_dir: str) -> str:
    """Stand-in facts beside rows that break the contract, one of each kind for the rows of a kind of day."""
    facts = _stored_facts(spark, sf_dir, BASES["mar"])

    def append(name: str, where: str, **changed: str) -> None:
        rows = facts.read(name).where(where)
        rows = rows.withColumns({c: F.expr(e).cast(rows.schema[c].dataType) for c, e in changed.items()})
        materialize(rows, "bad-rows").write.mode("append").parquet(f"{facts.folder}/{name}")

    append("card_daily", "day(date) = 7")
    append("card_daily", "day(date) = 9", date="CAST(NULL AS DATE)")
    append("entry_type_daily", "day(date) = 11 AND type_code > 0", type_code="CAST(NULL AS INT)")
    append("fee_rows", "day(created_at) = 12", created_at="CAST(NULL AS TIMESTAMP_NTZ)")
    append("acceptor_cube", "day(date) = 13", tx_daily="-tx_daily")
    append("acceptor_cube", "day(date) = 14", acceptor_id="20000", users_daily="users_mtd + 1")
    for value in ("volume + 1", "volume + 2"):
        append("entry_type_daily", "day(date) = 15 AND type_code < 1000", type_code="type_code + 1000", volume=value)
    return facts.folder


def close_month_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The March close on the rows that keep the contract of the facts."""
    return run_day(spark, check_facts(spark, _facts_with_bad_rows(spark, sf_dir)).inputs(), BASES["mar"])


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows set aside, counted by fact, day and reason."""
    bad = check_facts(spark, _facts_with_bad_rows(spark, sf_dir)).bad
    return bad.groupBy("fact", "day", "reason").agg(F.count("row").alias("n_rows"), F.sum("copies").alias("n_copies"))


def backfill_two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of 1998-03-01..1998-04-01 (February and March) in one job."""
    return backfill(spark, _tables(spark, sf_dir), BASES["feb"], BASES["mar"])


def backfill_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O16 over every day of lineitem's ship-date range, in one job."""
    t = _tables(spark, sf_dir)
    bounds = t.lineitem.agg(F.min(F.to_date("l_shipdate")).alias("lo"),
                            F.max(F.to_date("l_shipdate")).alias("hi")).first()
    lo, hi = bounds["lo"], bounds["hi"] + dt.timedelta(days=1)
    inputs = one_pass_inputs(t, history_start(py_add_months(lo, -1)))
    return forecast_days(spark, inputs, lo, hi, "self")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "spine_data_days": spine_data_days,
        "spine_data_days_own_shift": lambda s, d: spine_data_days(s, d, own_month_shift=True),
        "week_start_lookup": week_start_lookup,
        "mtd_by_day": mtd_by_day,
        "mtd_with_ties": mtd_with_ties,
        "calendar_days": calendar_days,
        "fee_rows": fee_rows,
        "card_daily": card_daily,
        "entry_type_daily": entry_type_daily,
        "acceptor_cube": acceptor_cube,
        "hourly_cube": hourly_cube,
        "pair_totals": pair_totals,
        "coded_series": coded,
        "row_fee_series": row_fee,
        "row_fee_fine": row_fee_fine,
        "cube_slice_series": cube_slices,
        "hourly_peak_series": hourly_peaks,
        "metric_series_all": metric_series_all,
        "lookup_mar": lambda s, d: _lookup(s, d, BASES["mar"]),
        "lookup_missing_days": lambda s, d: _lookup(s, d, EVENTS_CLOSE, only_hourly=True),
        "pace_rates_mar": _run("mar", "rates"),
        "pace_expected_feb": _run("feb", "expected"),
        "pace_expected_mar": _run("mar", "expected"),
        "pace_expected_sep": _run("sep", "expected"),
        "pace_expected_mid": _run("mid", "expected"),
        "bands_mar": _run("mar", "bands"),
        "errors_closed_mar": _run("mar", "errors"),
        "errors_open_mid": _run("mid", "errors"),
        "linear_mar": _run("mar", "linear"),
        "lookback_accuracy_mar": _run("mar", "lookback"),
        "close_month_all": _run("mar", "all"),
        "close_month_sep_own_shift": _run("sep", "all", own_month_shift=True),
        "run_day_mid_all": _run("mid", "all"),
        "slice_rewrite_twice": slice_rewrite_twice,
        "close_two_months_stored": close_two_months_stored,
        "slice_rewrite_drops_day": slice_rewrite_drops_day,
        "close_month_from_facts": close_month_from_facts,
        "run_day_from_store": run_day_from_store,
        "run_day_late_rows": run_day_late_rows,
        "committed_rewrite_twice": committed_rewrite_twice,
        "committed_two_months": committed_two_months,
        "backfill_pieces_resumed": backfill_pieces_resumed,
        "restated_month": restated_month,
        "restated_late_rows": restated_late_rows,
        "close_month_checked": close_month_checked,
        "quarantined_rows": quarantined_rows,
        "backfill_two_months": backfill_two_months,
        "backfill_all_days": backfill_all_days,
    }
    return q
