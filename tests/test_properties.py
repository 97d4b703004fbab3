"""Property-based checks (Hypothesis) of the month-to-date scan."""
import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pacecast.operators.series import month_to_date
from test_series import brute_mtd

BASE = dt.datetime(2024, 1, 30, 23, 59, 58)

timestamps = st.builds(
    lambda days, secs, micros: BASE + dt.timedelta(days=days, seconds=secs, microseconds=micros),
    st.integers(0, 3), st.sampled_from([0, 1, 2, 3, 86_399]), st.sampled_from([0, 1, 999_999]))
values = st.one_of(st.none(), st.integers(-10_000, 10_000).map(lambda c: Decimal(c) / 100))
rows = st.lists(st.tuples(st.sampled_from(["a", "b"]), timestamps, values), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows)
def test_month_to_date_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v decimal(20,2)")
    got = {(r["k"], r["date"]): (r["value"], r["value_ptd"])
           for r in month_to_date(df, ["k"], "ts", "v").collect()}
    assert got == brute_mtd(data)
