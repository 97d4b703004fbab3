import datetime as dt

from conftest import day

from pacecast.functions.dates import py_add_months, run_window
from pacecast.operators.calendar import (calendar_from_range, calendar_spine, spine_for_anchors,
                                         week_start)


def spine_rows(spark, base, own=False):
    return {r["anchor"]: r for r in calendar_spine(spark, base, own_month_shift=own).collect()}


def test_run_window_first_of_month_recomputes_previous_month():
    assert run_window("1998-03-01") == (day("1998-02-01"), day("1998-03-01"))
    assert run_window("1999-01-01") == (day("1998-12-01"), day("1999-01-01"))


def test_run_window_ordinary_day_is_yesterday():
    assert run_window("1998-04-15") == (day("1998-04-14"), day("1998-04-15"))


def test_close_of_february_spine(spark):
    rows = spine_rows(spark, "1998-03-01")
    assert len(rows) == 28
    r = rows[day("1998-02-10")]
    assert r["period_start"] == day("1998-02-01")
    assert r["history_start"] == day("1997-11-01")
    assert (r["e0"], r["e1"], r["e2"], r["e3"]) == (
        day("1998-02-28"), day("1998-01-31"), day("1997-12-31"), day("1997-11-30"))
    # February is shorter: earlier month ends move back, nothing is added
    assert (r["m1"], r["m2"]) == (day("1998-01-28"), day("1997-12-28"))
    # three-month alignment re-uses the one-month shortfall (-3), not its own (-2)
    assert r["m3"] == day("1997-11-27")
    assert (r["x1"], r["x2"], r["x3"]) == (0, 0, 0)
    assert (r["p1"], r["p2"], r["p3"]) == (day("1998-01-10"), day("1997-12-10"), day("1997-11-10"))


def test_own_month_shift_option(spark):
    r = spine_rows(spark, "1998-03-01", own=True)[day("1998-02-10")]
    assert r["m3"] == day("1997-11-28")


def test_close_of_march_clamps_late_days(spark):
    rows = spine_rows(spark, "2024-04-01")
    assert len(rows) == 31
    for d in ("2024-03-29", "2024-03-30", "2024-03-31"):
        assert rows[day(d)]["p1"] == day("2024-02-29")
    r = rows[day("2024-03-31")]
    # March is longer than February by 2 days, than January by none
    assert (r["x1"], r["x2"], r["x3"]) == (2, 0, 0)
    assert r["m1"] == day("2024-02-29")
    assert r["p3"] == day("2023-12-31")


def test_september_close(spark):
    r = spine_rows(spark, "1998-10-01")[day("1998-09-30")]
    assert (r["e1"], r["e2"], r["e3"]) == (day("1998-08-31"), day("1998-07-31"), day("1998-06-30"))
    assert (r["m1"], r["m2"], r["m3"]) == (day("1998-08-30"), day("1998-07-30"), day("1998-06-29"))
    assert (r["x1"], r["x2"], r["x3"]) == (0, 0, 0)


def test_year_crossing(spark):
    rows = spine_rows(spark, "1999-01-01")
    r = rows[day("1998-12-31")]
    assert r["period_start"] == day("1998-12-01")
    assert r["p3"] == day("1998-09-30")
    assert r["history_start"] == day("1998-09-01")


def test_mid_month_single_anchor(spark):
    rows = spine_rows(spark, "1998-04-15")
    assert list(rows) == [day("1998-04-14")]


def test_spine_over_data_days(spark):
    df = spark.createDataFrame([(day("2024-02-29"),), (day("2024-03-31"),)], "anchor date")
    got = {r["anchor"]: r for r in spine_for_anchors(df).collect()}
    assert got[day("2024-02-29")]["p1"] == day("2024-01-29")
    assert got[day("2024-03-31")]["p1"] == day("2024-02-29")


def test_driver_side_add_months_matches_spark(spark):
    days = [day("2024-03-31"), day("2024-02-29"), day("1998-12-31"), day("1999-01-30")]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    for k in (-1, -2, -3, 1):
        got = [r[0] for r in df.selectExpr(f"add_months(d, {k})").collect()]
        assert got == [py_add_months(d, k) for d in days]


def test_week_start_is_first_calendar_day_of_week(spark):
    cal = calendar_from_range(spark, day("2024-01-03"), day("2024-01-20"))
    got = {r["day"]: (r["week_start"], r["prev_week_start"]) for r in week_start(cal).collect()}
    # calendar starts on a Wednesday: that partial week starts on its first day
    assert got[day("2024-01-05")] == (day("2024-01-03"), day("2023-12-27"))
    assert got[day("2024-01-10")] == (day("2024-01-08"), day("2024-01-01"))
    assert got[day("2024-01-14")] == (day("2024-01-08"), day("2024-01-01"))
    assert got[day("2024-01-15")] == (day("2024-01-15"), day("2024-01-08"))


def test_week_start_probe_outside_calendar_is_null(spark):
    cal = calendar_from_range(spark, day("2024-01-03"), day("2024-01-20"))
    days = spark.createDataFrame([(dt.date(2023, 12, 1),)], "day date")
    row = week_start(cal, days).collect()[0]
    assert row["week_start"] is None


def _model(a: dt.date, own: bool = False) -> dict:
    """Plain-Python statement of the role dates of one anchor."""
    def last_day(d):
        nxt = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
        return nxt - dt.timedelta(days=1)
    s0 = a.replace(day=1)
    e = {0: last_day(a)}
    for k in (1, 2, 3):
        e[k] = last_day(py_add_months(s0, -k))
    diff = {k: e[0].day - e[k].day for k in (1, 2, 3)}
    out = {"period_start": s0, "history_start": py_add_months(s0, -3),
           "days_in_month": e[0].day}
    for k in (1, 2, 3):
        out[f"p{k}"] = py_add_months(a, -k)
        out[f"e{k}"] = e[k]
        out[f"x{k}"] = max(diff[k], 0)
    out["e0"] = e[0]
    out["m1"] = e[1] + dt.timedelta(days=min(diff[1], 0))
    out["m2"] = e[2] + dt.timedelta(days=min(diff[2], 0))
    out["m3"] = e[3] + dt.timedelta(days=min(diff[3] if own else diff[1], 0))
    return out


def test_spine_matches_model_on_every_day(spark):
    days = []
    for start, end in ((dt.date(1999, 1, 1), dt.date(2001, 12, 31)),
                       (dt.date(2099, 1, 1), dt.date(2101, 12, 31))):
        days += [start + dt.timedelta(days=i) for i in range((end - start).days + 1)]
    df = spark.createDataFrame([(d,) for d in days], "anchor date")
    for own in (False, True):
        for r in spine_for_anchors(df, own_month_shift=own).collect():
            want = _model(r["anchor"], own)
            got = {k: r[k] for k in want}
            assert got == want, r["anchor"]


def test_empty_anchor_range_does_not_count_down(spark):
    from pacecast.operators.calendar import anchor_range
    assert anchor_range(spark, day("2024-03-05"), day("2024-03-05")).count() == 0
    assert anchor_range(spark, day("2024-03-05"), day("2024-03-01")).count() == 0
    assert anchor_range(spark, day("2024-03-05"), day("2024-03-06")).count() == 1


def test_backfill_spine_covers_every_recomputed_day(spark):
    from pacecast.operators.calendar import backfill_spine
    days = sorted(r["anchor"] for r in backfill_spine(spark, "1998-03-01", "1998-04-15").collect())
    assert days[0] == day("1998-02-01") and days[-1] == day("1998-04-14")
    assert len(days) == (day("1998-04-15") - day("1998-02-01")).days
