import datetime as dt

from conftest import D, day, series_frame
from pyspark.sql import functions as F

from pacecast.operators.calendar import calendar_spine
from pacecast.operators.lookup import PTD_ROLES, VALUE_ROLES, period_lookup


def conditional_form(series, spine):
    """The reference's shape: every anchor against every row on/after its
    history start, one conditional max per role (a nested-loop join)."""
    j = spine.crossJoin(series).filter(F.col("date") >= F.col("history_start"))
    aggs = [F.max(F.when(F.col("date") == F.col(r), F.col("value_ptd"))).alias(f"P_{r}")
            for r in PTD_ROLES]
    aggs += [F.max(F.when(F.col("date") == F.col(r), F.col("value"))).alias(f"V_{r}")
             for r in VALUE_ROLES]
    return (j.groupBy(F.col("anchor").alias("date"), "feature", "measure", "period", "entity",
                      "currency").agg(*aggs))


def make_series(spark):
    rows = []
    d = dt.date(1997, 10, 1)
    while d <= dt.date(1998, 4, 30):
        if d.day != 15:  # a missing day each month
            rows.append((d.isoformat(), 1, d.day, d.day * 10))
        if d >= dt.date(1998, 3, 20):  # starts after history start, alive via later rows
            rows.append((d.isoformat(), 2, 1, 1))
        if d <= dt.date(1997, 10, 31):  # ends before the history start: not alive
            rows.append((d.isoformat(), 3, 1, 1))
        d += dt.timedelta(days=1)
    rows.append(("1998-03-15", 4, None, None))  # NULL values on an anchor
    return series_frame(spark, rows)


def test_equi_join_form_equals_conditional_form(spark):
    series = make_series(spark)
    for base in ("1998-03-01", "1998-04-01", "1998-04-16"):
        spine = calendar_spine(spark, base)
        got = period_lookup(series, spine).drop("x1", "x2", "x3", "days_in_month")
        want = conditional_form(series, spine)
        assert got.exceptAll(want.select(got.columns)).count() == 0
        assert want.select(got.columns).exceptAll(got).count() == 0


def test_missing_day_and_alive_rules(spark):
    series = make_series(spark)
    rows = {(r["date"], r["feature"]): r
            for r in period_lookup(series, calendar_spine(spark, "1998-04-01")).collect()}
    assert {f for _, f in rows} == {1, 2, 4}          # feature 3 ended too early
    r = rows[(day("1998-03-15"), 1)]
    assert r["P_anchor"] is None                       # missing day: NULL, not 0
    assert r["P_p1"] is None                           # 1998-02-15 is missing too
    assert rows[(day("1998-03-16"), 1)]["P_p1"] == D(160)
    r2 = rows[(day("1998-03-01"), 2)]
    assert r2["P_anchor"] is None and r2["P_p1"] is None  # alive, but nothing to read


def test_without_broadcast_same_rows(spark, monkeypatch):
    import pacecast.operators.lookup as lookup
    series = make_series(spark)
    spine = calendar_spine(spark, "1998-04-01")
    with_hint = period_lookup(series, spine, 31)
    monkeypatch.setattr(lookup, "MAX_BROADCAST_ANCHORS", 0)   # beyond the gate: planner decides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        without = period_lookup(series, spine, 31)
        plan = without._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        assert without.exceptAll(with_hint).count() == 0 and with_hint.exceptAll(without).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
