"""Plan-shape regression checks (the properties PLANS.md reports)."""
import datetime as dt
import re

from conftest import SF_SMOKE

from pacecast.operators.calendar import calendar_spine
from pacecast.operators.series import metric_series
from pacecast.plans.pipeline import forecast_frame
from pacecast.sources.standins import standin_inputs
from pacecast.sources.tables import TableSet

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_series_plan_pushes_history_bound_and_prunes_columns(spark):
    since = dt.date(1997, 11, 1)
    plan = plan_of(metric_series(spark, standin_inputs(TableSet(spark, SF_SMOKE), since), since))
    assert not any(word in plan for word in FORBIDDEN)
    for table, ts in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"), ("events", "ts")):
        scans = [l for l in plan.split("\n") if "FileScan parquet" in l and f"/{table}.parquet" in l]
        assert scans, table
        for line in scans:
            if table == "orders" and "o_custkey" in line:
                continue  # the cube's order lookup is a key join, not a dated scan
            assert re.search(rf"PushedFilters: \[[^\]]*GreaterThanOrEqual\({ts},1997-11-01", line), line
            read = re.search(r"ReadSchema: (\S+)", line).group(1)
            # columns no metric needs are never read
            assert not any(c in read for c in ("l_partkey", "l_discount", "l_tax", "o_orderstatus",
                                                 "o_orderpriority", "props", "event_id"))


def test_forecast_plan_has_no_nested_loop(spark):
    since = dt.date(1997, 11, 1)
    series = metric_series(spark, standin_inputs(TableSet(spark, SF_SMOKE), since), since)
    plan = plan_of(forecast_frame(series, calendar_spine(spark, "1998-04-01"), 31,
                                  (dt.date(1998, 3, 1), dt.date(1998, 3, 1))))
    assert not any(word in plan for word in FORBIDDEN)
    assert "BroadcastHashJoin" in plan


def test_date_partitioned_fact_is_pruned_by_history_bound(spark):
    from pacecast.operators.series import CODED_METRICS, coded_series
    from pacecast.session import scratch_path
    from pacecast.sources.standins import entry_type_daily
    path = scratch_path(spark, "t-partitioned-fact")
    entry_type_daily(TableSet(spark, SF_SMOKE).lineitem).write.partitionBy("date").parquet(path)
    fact = spark.read.parquet(path)
    plan = plan_of(coded_series(spark, fact, CODED_METRICS, since=dt.date(1998, 1, 1)))
    scan = [l for l in plan.split("\n") if "FileScan parquet" in l][0]
    assert re.search(r"PartitionFilters: \[[^\]]*\(date#\d+ >= 1998-01-01\)", scan), scan
