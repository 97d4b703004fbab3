"""Every registered query against its DuckDB oracle on sf0.001 (the
driver does the same at sf0.01)."""
import datetime as dt
import decimal
from collections import Counter

import duckdb
import pytest
from conftest import SF_SMOKE

import __spark_entry__ as entry
import oracle_sql_text
from pacecast.plans import queries as own
from pacecast.sources.tables import TABLES

# the library's own queries; those of the optional subpackage have their tests in tests/llm
QUERIES = own.registry()
ORACLE = oracle_sql_text.registry()
# queries without SQL oracle (checked against brute force elsewhere)
NO_ORACLE = set(QUERIES) - set(ORACLE)


def canon(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v != 0 else "0"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMOKE}/{t}.parquet')")
    return con


def test_oracle_keys_are_queries():
    assert set(ORACLE) <= set(QUERIES)
    assert NO_ORACLE == set()
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMOKE)
    rel = duck.sql(ORACLE[name])
    assert [c.lower() for c in sdf.columns] == [c.lower() for c in rel.columns]
    got = Counter(tuple(canon(x) for x in r) for r in sdf.collect())
    want = Counter(tuple(canon(x) for x in r) for r in rel.fetchall())
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 43
    assert df.count() > 0
