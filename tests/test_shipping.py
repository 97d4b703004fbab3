"""The one pass over lineitem against the facts built one by one."""
import datetime as dt
import re
from collections import Counter
from types import SimpleNamespace

import pytest
from conftest import SF_SMOKE

from pacecast.operators.series import metric_series
from pacecast.sources import shipping
from pacecast.sources.shipping import one_pass_inputs, shipping_days
from pacecast.sources.standins import standin_inputs
from pacecast.sources.tables import TableSet

#: The facts that come from the pass; the others are built as they were.
FACTS = ("card_daily", "entry_type_daily", "acceptor_cube")


def assert_same_facts(tables, *bounds):
    got, want = one_pass_inputs(tables, *bounds), standin_inputs(tables, bounds[0], until=bounds[1])
    for name in FACTS:
        a, b = getattr(got, name), getattr(want, name)
        assert a.dtypes == b.dtypes, name
        assert Counter(a.collect()) == Counter(b.collect()), name


@pytest.mark.parametrize("bounds", [(None, None), (dt.date(1997, 11, 1), dt.date(1998, 4, 15))])
def test_same_facts_as_one_by_one(spark, bounds):
    assert_same_facts(TableSet(spark, SF_SMOKE), *bounds)


def awkward(spark, repeats=1):
    """Line items without a day, a status, a flag, an order, a customer, a supplier or a nation."""
    day = dt.datetime(2024, 1, 31, 5)
    items = [(1, 1, day, "F", "R", 5.25, 1.0), (1, 2, day, "O", "N", 7.5, 2.0), (1, 1, None, "F", "N", 1.0, 1.0),
             (2, 1, day, None, "N", 2.0, 1.0), (2, 2, dt.datetime(2024, 2, 1), "F", None, 3.0, 1.0),
             (99, 1, day, "F", "N", 10.0, 1.0), (None, 1, day, "O", "N", 11.0, 1.0), (3, 1, day, "F", "N", 12.0, 1.0),
             (4, 1, day, "O", "N", 13.0, 1.0), (1, 98, day, "F", "N", 14.0, 1.0), (1, None, day, "F", "N", 15.0, 1.0),
             (2, 1, dt.datetime(2024, 2, 1, 9), "X", "N", None, None)] * repeats
    return SimpleNamespace(
        lineitem=spark.createDataFrame(
            items, "l_orderkey long, l_suppkey long, l_shipdate timestamp_ntz, l_linestatus string, "
                   "l_returnflag string, l_extendedprice double, l_quantity double"),
        orders=spark.createDataFrame(
            [(1, 1, day, 3.0), (2, 2, day, 4.0), (3, 97, day, 5.0), (4, 3, day, 6.0), (5, None, None, None)],
            "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double"),
        customer=spark.createDataFrame([(1, 1, "BUILDING"), (2, 2, "OTHER"), (3, None, None)],
                                       "c_custkey long, c_nationkey int, c_mktsegment string"),
        supplier=spark.createDataFrame([(1, 1), (2, 2)], "s_suppkey long, s_nationkey int"),
        events=spark.createDataFrame([], "ts timestamp_ntz, user_id long, event_type string"))


@pytest.mark.parametrize("repeats", [1, 3])
def test_awkward_line_items(spark, repeats):
    assert_same_facts(awkward(spark, repeats), None, None)


def test_empty_tables(spark):
    tables = awkward(spark)
    for name in vars(tables):
        setattr(tables, name, getattr(tables, name).limit(0))
    assert_same_facts(tables, None, None)


def scans(df, table):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in plan.split("\n") if "FileScan parquet" in x and f"/{table}.parquet" in x]


def test_lineitem_is_read_once(spark):
    tables, since = TableSet(spark, SF_SMOKE), dt.date(1997, 11, 1)
    scan, = scans(shipping_days(tables, since), "lineitem")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate,1997-11-01", scan), scan
    assert not any(c in scan.split("ReadSchema:")[1] for c in ("l_partkey", "l_discount", "l_tax"))
    series = metric_series(spark, one_pass_inputs(tables, since), since)
    assert not scans(series, "lineitem") and len(scans(series, "orders")) == 1


@pytest.mark.parametrize("name", ["backfill_pieces_resumed", "committed_two_months", "slice_rewrite_twice"])
def test_runs_on_the_same_tables_build_the_facts_once(spark, monkeypatch, name):
    from pacecast.plans import queries

    built = []
    monkeypatch.setattr(shipping, "shipping_days", lambda *a, plain=shipping.shipping_days: built.append(a) or plain(*a))
    queries.registry()[name](spark, SF_SMOKE)
    assert len(built) == 1


def test_pieces_of_a_backfill_share_the_facts(spark, monkeypatch, tmp_path):
    from pacecast.plans.pipeline import backfill_in_pieces
    from pacecast.sources.commits import CommittedTable

    built = []
    monkeypatch.setattr(shipping, "shipping_days", lambda *a, plain=shipping.shipping_days: built.append(a) or plain(*a))
    backfill_in_pieces(spark, TableSet(spark, SF_SMOKE), "1998-03-01", "1998-04-01",
                       CommittedTable(spark, str(tmp_path / "t")), run="r")
    assert len(built) == 1
