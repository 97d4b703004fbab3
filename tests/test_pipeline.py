import datetime as dt

import pytest
from conftest import SF_SMOKE, day

from pacecast.plans.pipeline import OUTPUT_COLUMNS, backfill, run_day
from pacecast.session import scratch_path
from pacecast.sources.store import read_output, stored_days, write_slice
from pacecast.sources.tables import TableSet


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*OUTPUT_COLUMNS).collect())


def test_run_day_shape(spark):
    df = run_day(spark, TableSet(spark, SF_SMOKE), "1998-04-15")
    assert df.columns == OUTPUT_COLUMNS
    rows = df.collect()
    assert len(rows) == 37
    assert {r["date"] for r in rows} == {day("1998-04-14")}


def test_open_month_from_data_that_stops_early(spark):
    # events end on 2024-01-30: January's end is not realised; only the six
    # hourly series reach a 2024 history window
    rows = run_day(spark, TableSet(spark, SF_SMOKE), "2024-01-15").collect()
    assert sorted((r["feature"], r["measure"]) for r in rows) == [
        (5, 0), (5, 4), (6, 0), (6, 4), (7, 0), (7, 4)]
    assert all(r["eop_realised"] is None and r["err_m1"] is None for r in rows)
    assert all(r["err_rate_m1"] == 0 and r["linear_err_rate"] == 0 for r in rows)
    # no earlier months: every month-k expectation is 0, the straight line is not
    assert all(r["exp_m1"] == 0 and r["exp_mean"] == 0 for r in rows)
    assert all(r["linear_exp"] is not None and r["linear_exp"] > 0 for r in rows)


def test_month_close_contains_the_daily_runs(spark):
    tables = TableSet(spark, SF_SMOKE)
    close_df = run_day(spark, tables, "1998-03-01")
    for r in close_df.collect():                      # spread and bands are consistent
        assert r["exp_std"] >= 0
        for name in ("exp_m1", "exp_m2", "exp_m3", "exp_mean"):
            assert r[f"{name}_lo"] <= float(r[name]) <= r[f"{name}_hi"]
    close = rows_of(close_df)
    assert {r[0] for r in close} == {dt.date(1998, 2, 1) + dt.timedelta(days=i) for i in range(28)}
    for base in ("1998-02-11", "1998-02-28"):
        daily = rows_of(run_day(spark, tables, base))
        assert daily and set(daily) <= set(close)


def test_backfill_equals_month_closes(spark):
    tables = TableSet(spark, SF_SMOKE)
    both = rows_of(backfill(spark, tables, "1998-03-01", "1998-04-01"))
    feb = rows_of(run_day(spark, tables, "1998-03-01"))
    mar = rows_of(run_day(spark, tables, "1998-04-01"))
    assert both == sorted(feb + mar)


def test_stored_history_feeds_lookback(spark):
    tables = TableSet(spark, SF_SMOKE)
    target = scratch_path(spark, "t-history")
    run_day(spark, tables, "1998-03-01", target=target)      # February into the table
    stored_mar = rows_of(run_day(spark, tables, "1998-04-01", target=target))
    in_job_mar = rows_of(run_day(spark, tables, "1998-04-01"))
    assert stored_mar == in_job_mar
    assert len(stored_days(spark, target)) == 28 + 31


def test_slice_rewrite_is_idempotent(spark):
    tables = TableSet(spark, SF_SMOKE)
    target = scratch_path(spark, "t-idem")
    first = rows_of(run_day(spark, tables, "1998-04-15", target=target))
    again = rows_of(run_day(spark, tables, "1998-04-15", target=target))
    assert first == again and len(first) == 37
    assert rows_of(read_output(spark, target)) == first


def test_empty_slice_deletes_days_and_rows_outside_are_not_written(spark):
    schema = "date date, v int"
    target = scratch_path(spark, "t-empty")
    df = spark.createDataFrame([(day("2024-01-01"), 1), (day("2024-01-02"), 2),
                                (day("2024-01-05"), 5)], schema)
    written = write_slice(df, target, day("2024-01-01"), day("2024-01-03"))
    assert written == [day("2024-01-01"), day("2024-01-02")]
    assert sorted(stored_days(spark, target)) == written
    write_slice(spark.createDataFrame([], schema), target, day("2024-01-02"), day("2024-01-03"))
    assert sorted(stored_days(spark, target)) == [day("2024-01-01")]
    assert [r["v"] for r in read_output(spark, target).collect()] == [1]


def test_results_do_not_depend_on_session_time_zone(spark):
    from pacecast.plans.queries import registry
    q = registry()
    names = ["hourly_cube", "lookup_missing_days", "mtd_with_ties"]
    base = {n: sorted(map(tuple, q[n](spark, SF_SMOKE).collect())) for n in names}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        for n in names:
            assert sorted(map(tuple, q[n](spark, SF_SMOKE).collect())) == base[n], n
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_as_of_drops_future_rows(spark):
    tables = TableSet(spark, SF_SMOKE)
    default = {(r["feature"], r["measure"]): r for r in run_day(spark, tables, "1998-04-15").collect()}
    capped = {(r["feature"], r["measure"]): r
              for r in run_day(spark, tables, "1998-04-15", as_of="1998-04-15").collect()}
    # the hourly series (2024 data) only reach a 1998 window through future rows
    assert set(default) - set(capped) == {(5, 0), (5, 4), (6, 0), (6, 4), (7, 0), (7, 4)}
    for key, row in capped.items():
        assert row["eop_realised"] is None                 # April is not over on the 15th
        assert row["ptd"] == default[key]["ptd"]            # figures up to the anchor unchanged
        assert row["exp_m1"] == default[key]["exp_m1"]


def test_stored_run_leaves_no_scratch_behind(spark):
    import os
    from pacecast.session import shared_dir
    base = shared_dir(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    before = set(os.listdir(local))
    target = scratch_path(spark, "t-clean")
    rows = run_day(spark, TableSet(spark, SF_SMOKE), "1998-04-15", target=target).collect()
    assert len(rows) == 37
    created = set(os.listdir(local)) - before
    assert created == {target.rsplit("/", 1)[-1]}


def test_command_line_run_day(spark, capsys):
    from pacecast.__main__ import main
    target = scratch_path(spark, "t-cli")
    main(["run-day", "--base-day", "1998-04-15", "--tables", SF_SMOKE, "--target", target])
    assert "stored 37 rows" in capsys.readouterr().out
    assert sorted(stored_days(spark, target)) == [day("1998-04-14")]


def test_failed_write_leaves_table_unchanged_and_rerun_completes(spark, monkeypatch):
    import pacecast.sources.store as store
    schema = "date date, v int"
    target = scratch_path(spark, "t-fail")
    old = spark.createDataFrame([(day("2024-01-01"), 1), (day("2024-01-02"), 2)], schema)
    write_slice(old, target, day("2024-01-01"), day("2024-01-03"))
    new = spark.createDataFrame([(day("2024-01-01"), 10), (day("2024-01-02"), 20)], schema)

    def boom(*args, **kwargs):
        raise RuntimeError("driver lost after staging")
    monkeypatch.setattr(store, "stored_days", boom)   # fails between staging and the final write
    try:
        write_slice(new, target, day("2024-01-01"), day("2024-01-03"))
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert sorted(r["v"] for r in read_output(spark, target).collect()) == [1, 2]
    write_slice(new, target, day("2024-01-01"), day("2024-01-03"))
    assert sorted(r["v"] for r in read_output(spark, target).collect()) == [10, 20]


def test_backfill_as_of_equals_run_day_as_of(spark):
    tables = TableSet(spark, SF_SMOKE)
    a = rows_of(backfill(spark, tables, "1998-04-01", "1998-04-01", as_of="1998-04-10"))
    b = rows_of(run_day(spark, tables, "1998-04-01", as_of="1998-04-10"))
    assert a == b and len(a) > 0


def test_readme_flow_with_separate_fact_frames(spark):
    from pyspark.sql import functions as F
    from pacecast.functions.dates import run_window
    from pacecast.plans.pipeline import OUTPUT_COLUMNS, forecast_days
    from pacecast.sources import standins
    from pacecast.sources.standins import Inputs

    t = TableSet(spark, SF_SMOKE)
    cube = standins.hourly_cube(t.events, full=False)
    bill, game, travel = (cube.filter(F.col("feature") == f).drop("feature") for f in (5, 6, 7))
    hourly = (bill.withColumn("feature", F.lit(5))
              .unionByName(game.withColumn("feature", F.lit(6)))
              .unionByName(travel.withColumn("feature", F.lit(7))))
    inputs = Inputs(card_daily=standins.card_daily(t.lineitem),
                    entry_type_daily=standins.entry_type_daily(t.lineitem),
                    fee_rows=standins.fee_rows(t.orders),
                    acceptor_cube=standins.acceptor_cube(t.lineitem, t.orders, t.customer,
                                                         t.supplier, full=False),
                    hourly_cube=hourly)
    target = scratch_path(spark, "t-readme")
    lo, hi = run_window("1998-04-15")
    rows = forecast_days(spark, inputs, lo, hi, history=read_output(spark, target, OUTPUT_COLUMNS))
    write_slice(rows, target, lo, hi, OUTPUT_COLUMNS)
    stored = rows_of(read_output(spark, target))
    assert stored == rows_of(run_day(spark, t, "1998-04-15", target=scratch_path(spark, "t-r2")))


@pytest.mark.parametrize("broken", ["before delete", "between", "after overwrite"])
def test_broken_rewrite_leaves_no_stale_day_and_completes(spark, monkeypatch, broken):
    """A slice that loses a day, broken off at each step: never the old day beside new ones."""
    from pyspark.sql.readwriter import DataFrameWriter

    from pacecast.sources import store

    def rows(days, v):
        return spark.createDataFrame([(day(d), v) for d in days], "date date, v int")

    target = scratch_path(spark, "t-broken")
    lo, hi = day("2024-01-01"), day("2024-01-04")
    store.write_slice(rows(["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"], 0), target, lo, day("2024-01-05"))
    new = rows(["2024-01-01", "2024-01-03"], 1)
    real_parquet, real_days = DataFrameWriter.parquet, store.stored_days

    def parquet(self, path, *args, **kw):
        if path == target and broken == "between":
            raise OSError("broken")
        real_parquet(self, path, *args, **kw)
        if path == target and broken == "after overwrite":
            raise OSError("broken")

    def days(session, path):
        if path == target and broken == "before delete":
            raise OSError("broken")
        return real_days(session, path)

    with monkeypatch.context() as m:
        m.setattr(DataFrameWriter, "parquet", parquet)
        m.setattr(store, "stored_days", days)
        with pytest.raises(OSError):
            store.write_slice(new, target, lo, hi)
    left = {(str(r["date"]), r["v"]) for r in store.read_output(spark, target).collect()}
    assert ("2024-01-04", 0) in left
    if any(v == 1 for _, v in left):
        assert not any(d == "2024-01-02" for d, _ in left)
    store.write_slice(new, target, lo, hi)
    assert {(str(r["date"]), r["v"]) for r in store.read_output(spark, target).collect()} == {
        ("2024-01-01", 1), ("2024-01-03", 1), ("2024-01-04", 0)}
