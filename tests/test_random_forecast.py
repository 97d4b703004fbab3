"""Random daily series with negative, zero, missing and NULL values:
Spark's lookup + forecast against the DuckDB integer-arithmetic oracle."""
import datetime as dt
import decimal
import random
from collections import Counter

import duckdb
import pandas as pd
import pytest

import oracle_sql_text as oracle
from pacecast.operators.calendar import calendar_spine
from pacecast.plans.pipeline import PRE_LOOKBACK, forecast_frame
from pacecast.functions.dates import run_window

from conftest import SERIES_SCHEMA


def canon(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v != 0 else "0"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def random_rows(seed: int):
    rnd = random.Random(seed)
    rows = []
    for feature in range(6):
        scale = rnd.choice([1, 100, 10 ** 6, 10 ** 9])
        d = dt.date(2023, 10, 1)
        ptd = decimal.Decimal(0)
        while d <= dt.date(2024, 4, 30):
            if d.day == 1:
                ptd = decimal.Decimal(0)
            r = rnd.random()
            if r < 0.08:                       # missing day
                d += dt.timedelta(days=1)
                continue
            v = decimal.Decimal(rnd.randint(-scale, 3 * scale)) / 100
            if r < 0.12:
                v = decimal.Decimal(0)
            ptd += v
            value, value_ptd = v, ptd
            if r > 0.97:
                value, value_ptd = None, None  # NULL values
            rows.append((d, feature, 0, 0, 0, 0, value, value_ptd))
            if rnd.random() < 0.05:            # a duplicate row on the day
                rows.append((d, feature, 0, 0, 0, 0, v / 2, ptd - 1))
            d += dt.timedelta(days=1)
    return rows


@pytest.mark.parametrize("seed,base", [(1, "2024-03-01"), (2, "2024-04-01"), (3, "2024-04-17"),
                                       (4, "2024-02-01"), (5, "2024-01-01")])
def test_random_series_matches_oracle(spark, seed, base):
    rows = random_rows(seed)
    series = spark.createDataFrame(rows, SERIES_SCHEMA)
    spine = calendar_spine(spark, base)
    got = forecast_frame(series, spine).select(*PRE_LOOKBACK)
    con = duckdb.connect()
    pdf = pd.DataFrame(rows, columns=["date", "feature", "measure", "period", "entity",
                                      "currency", "value", "value_ptd"])
    con.register("series_pdf", pdf)
    con.execute("CREATE TABLE series_rows AS SELECT CAST(date AS DATE) AS date, "
                "CAST(feature AS INTEGER) AS feature, CAST(measure AS INTEGER) AS measure, "
                "CAST(period AS INTEGER) AS period, CAST(entity AS INTEGER) AS entity, "
                "CAST(currency AS INTEGER) AS currency, CAST(value AS DECIMAL(21,2)) AS value, "
                "CAST(value_ptd AS DECIMAL(31,2)) AS value_ptd FROM series_pdf")
    lo, hi = run_window(base)
    rel = con.sql(oracle.forecast_from_series_sql(lo, hi))
    assert [c.lower() for c in rel.columns] == [c.lower() for c in got.columns]
    want = Counter(tuple(canon(x) for x in r) for r in rel.fetchall())
    have = Counter(tuple(canon(x) for x in r) for r in got.collect())
    assert have == want
