
from conftest import D

from pacecast.operators.backtest import backtest_errors, lookback_accuracy
from pacecast.operators.forecast import dispersion_bands, linear_projection, pace_forecast

LOOKUP_SCHEMA = ("date date, x1 int, x2 int, x3 int, days_in_month int, feature int, measure int, "
                 "period int, entity int, currency int, " + ", ".join(
                     f"P_{r} decimal(31,2)" for r in
                     ["anchor", "p1", "p2", "p3", "m1", "m2", "m3", "e0", "e1", "e2", "e3"])
                 + ", V_e1 decimal(21,2), V_e2 decimal(21,2), V_e3 decimal(21,2)")


def lookup_row(spark, **kw):
    import datetime as dt
    base = dict(date=dt.date(2024, 3, 10), x1=2, x2=0, x3=0, days_in_month=31, feature=1, measure=5,
                period=0, entity=0, currency=0)
    for r in ["anchor", "p1", "p2", "p3", "m1", "m2", "m3", "e0", "e1", "e2", "e3"]:
        base[f"P_{r}"] = None
    for r in ["e1", "e2", "e3"]:
        base[f"V_{r}"] = None
    base.update({k: (D(v) if v is not None and k[:2] in ("P_", "V_") else v) for k, v in kw.items()})
    cols = [c.split()[0] for c in LOOKUP_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(base[c] for c in cols)], LOOKUP_SCHEMA)


def full(df):
    return linear_projection(backtest_errors(dispersion_bands(pace_forecast(df)))).collect()[0]


def test_expectations_exact(spark):
    row = full(lookup_row(spark, P_anchor=100, P_p1=90, P_m1=270, V_e1=10, P_e1=270,
                          P_p2=50, P_m2=150, P_e2=150, P_p3=30, P_m3=120, P_e3=120))
    # month 1 was 2 days shorter: its end counts 2 more days at the last-day value
    assert row["eop_adj_m1"] == D("290.00")
    assert row["rate_m1"] == D("0.3103448275862069")       # 90 / 290 at 16 decimals
    assert row["exp_m1"] == D("322.22")                     # 100 / 0.310345
    assert row["rate_m2"] == D("0.333333")
    assert row["exp_m2"] == D("300.00")                     # 100 / 0.333333 -> 300.0003
    assert row["exp_m3"] == D("400.00")                     # 100 * 120 / 30
    assert row["exp_mean"] == D("340.74")
    assert row["exp_std"] >= 0
    for name in ("exp_m1", "exp_m2", "exp_m3", "exp_mean"):
        assert row[f"{name}_lo"] <= float(row[name]) <= row[f"{name}_hi"]


def test_zero_and_missing_denominators_give_zero(spark):
    row = full(lookup_row(spark, P_anchor=100, P_p1=0, P_m1=0, V_e1=0, P_p2=None, P_m2=5))
    assert row["rate_m1"] == 0 and row["exp_m1"] == 0
    assert row["rate_m2"] == 0 and row["exp_m2"] == 0
    assert row["exp_m3"] == 0                                 # P_p3 missing
    assert row["exp_mean"] == D("0.00")
    assert row["eop_adj_m2"] == D("5.00")                    # no excess days: the aligned PTD
    assert row["eop_adj_m3"] is None                         # aligned PTD missing: NULL
    # month 1 longer-by-2 with its last-day value missing: NULL end, rate 0
    assert full(lookup_row(spark, P_m1=5))["eop_adj_m1"] is None


def test_mean_counts_missing_month_as_zero(spark):
    row = full(lookup_row(spark, P_anchor=100, P_p1=50, P_m1=100, V_e1=0, P_p2=50, P_m2=100))
    assert (row["exp_m1"], row["exp_m2"], row["exp_m3"]) == (D(200), D(200), D(0))
    assert row["exp_mean"] == D("133.33")


def test_open_month_errors_null_rates_zero(spark):
    row = full(lookup_row(spark, P_anchor=100, P_p1=50, P_m1=100, V_e1=0))
    assert row["eop_realised"] is None
    assert row["err_m1"] is None and row["err_rate_m1"] == 0
    assert row["linear_err"] is None and row["linear_err_rate"] == 0
    assert row["linear_exp"] == D("310.00")                   # 31 * 100 / 10


def test_closed_month_errors(spark):
    row = full(lookup_row(spark, P_anchor=100, P_p1=50, P_m1=100, V_e1=0, P_e0=250))
    assert row["err_m1"] == D("-50.00")
    assert row["err_rate_m1"] == D("-0.200000")
    assert row["linear_err"] == D("60.00")
    assert row["linear_err_rate"] == D("0.240000")


def test_lookback_accuracy_quirks_and_fan_out(spark):
    import datetime as dt
    cur = spark.createDataFrame(
        [(dt.date(2024, 3, 30), 1, 0, 0, 0, 0), (dt.date(2024, 3, 31), 1, 0, 0, 0, 0),
         (dt.date(2024, 3, 10), 2, 0, 0, 0, 0)],
        "date date, feature int, measure int, period int, entity int, currency int")
    hist = spark.createDataFrame(
        [(dt.date(2024, 2, 29), 1, 0, 0, 0, 0, D("-2.5"), D("0.25")),
         (dt.date(2024, 2, 10), 2, 0, 0, 0, 0, D("1.5"), D("0")),
         (dt.date(2024, 2, 10), 2, 0, 0, 0, 0, D("0.1"), D("0"))],
        "date date, feature int, measure int, period int, entity int, currency int, "
        "err_rate_m1 decimal(20,6), linear_err_rate decimal(38,6)")
    rows = sorted((r["date"], r["acc_prev_m1"], r["acc_prev_linear"])
                  for r in lookback_accuracy(cur, hist).collect())
    assert rows == [
        (dt.date(2024, 3, 10), D("0.500000"), D("1.000000")),   # |1-|1.5|| rises again
        (dt.date(2024, 3, 10), D("0.900000"), D("1.000000")),   # duplicates fan out
        (dt.date(2024, 3, 30), D("1.500000"), D("0.750000")),   # 30th and 31st both -> 29th
        (dt.date(2024, 3, 31), D("1.500000"), D("0.750000")),
    ]
