"""Atomic slice commits, the stored daily series and resumable backfills."""
import datetime as dt
import re

import pytest
from conftest import SF_SMOKE, day

from pacecast.operators.series import metric_series
from pacecast.plans import pipeline
from pacecast.plans.pipeline import OUTPUT_COLUMNS, backfill, backfill_in_pieces, run_day
from pacecast.plans.queries import LATE_FEES, LATE_REPORT, add_late_rows
from pacecast.plans.series_store import FactFolder, SeriesStore, day_ranges
from pacecast.session import scratch_path
from pacecast.sources import commits
from pacecast.sources.commits import CommittedTable
from pacecast.sources.standins import read_facts, standin_inputs, write_facts
from pacecast.sources.tables import TableSet


def rows(spark, days, v):
    return spark.createDataFrame([(day(d), v) for d in days], "date date, v int")


def found(frame):
    return sorted((str(r["date"]), r["v"]) for r in frame.collect())


@pytest.fixture
def table(spark):
    out = CommittedTable(spark, scratch_path(spark, "t-commits"))
    assert out.read() is None and out.parts() == {} and out.versions() == []
    out.replace_days(rows(spark, ["2024-01-01", "2024-01-02", "2024-01-04"], 0), day("2024-01-01"), day("2024-01-05"))
    return out


OLD = [("2024-01-01", 0), ("2024-01-02", 0), ("2024-01-04", 0)]
NEW = [("2024-01-01", 1), ("2024-01-03", 1), ("2024-01-04", 0)]
SLICE = (day("2024-01-01"), day("2024-01-04"))


def test_replace_swaps_whole_slices(spark, table):
    before = table.read()
    written = table.replace_days(rows(spark, ["2024-01-01", "2024-01-03", "2024-02-01"], 1), *SLICE)
    assert written == [day("2024-01-01"), day("2024-01-03")]
    assert found(table.read()) == NEW
    assert found(before) == OLD  # a frame opened before the commit still sees the old slice, whole
    assert found(table.read(version=1)) == OLD
    assert found(table.read(day("2024-01-02"), day("2024-01-04"))) == [("2024-01-03", 1)]
    plan = table.read(day("2024-01-03"), day("2024-01-04"))
    assert len(plan.inputFiles()) == 1  # other parts are not even listed
    table.replace_days(rows(spark, [], 1), day("2024-01-01"), day("2024-02-01"))
    assert found(table.read()) == [] and table.read().columns == ["v", "date"]


@pytest.mark.parametrize("broken", ["data", "manifest", "after"])
def test_broken_commit_changes_nothing_and_is_completed(spark, table, monkeypatch, broken):
    real = CommittedTable._add_manifest

    def names(self, *folder):
        if broken == "data" and folder and folder[0].startswith("commit="):
            raise OSError("broken")
        return real_names(self, *folder)

    def add(self, *args):
        if broken == "manifest":
            raise OSError("broken")
        real(self, *args)
        raise OSError("broken")

    real_names = CommittedTable._names
    with monkeypatch.context() as m:
        m.setattr(CommittedTable, "_names", names)
        if broken != "data":
            m.setattr(CommittedTable, "_add_manifest", add)
        with pytest.raises(OSError):
            table.replace_days(rows(spark, ["2024-01-01", "2024-01-03"], 1), *SLICE)
    assert found(table.read()) == (NEW if broken == "after" else OLD)
    table.replace_days(rows(spark, ["2024-01-01", "2024-01-03"], 1), *SLICE)
    assert found(table.read()) == NEW
    assert table.vacuum(keep=1) == 1  # what the broken write, or the one done again, left
    assert found(table.read()) == NEW and len(table.versions()) == 1


def test_two_writers_both_land(spark, table, monkeypatch):
    """Another writer commits between reading the manifest and adding the next one."""
    other, real = CommittedTable(spark, table.path), CommittedTable.manifest
    waiting = [True]

    def manifest(self, version=None):
        out = real(self, version)
        if self is table and waiting:
            waiting.clear()
            other.replace_days(rows(spark, ["2024-01-04"], 7), day("2024-01-04"), day("2024-01-05"))
        return out

    monkeypatch.setattr(CommittedTable, "manifest", manifest)
    table.replace_days(rows(spark, ["2024-01-01", "2024-01-03"], 1), *SLICE)
    assert found(table.read()) == [*NEW[:2], ("2024-01-04", 7)]
    assert table.versions() == [1, 2, 3]


def test_rows_outside_the_slice_or_without_a_date_are_refused(spark, table):
    with pytest.raises(ValueError):
        table.replace(rows(spark, ["2024-03-01"], 1), lambda d: d.month == 1)
    with pytest.raises(ValueError):
        table.replace(spark.createDataFrame([(None, 1)], "date date, v int"), lambda d: True)
    assert found(table.read()) == OLD


def test_a_large_day_is_written_by_several_tasks(spark):
    target = CommittedTable(spark, scratch_path(spark, "t-skew"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        big = spark.range(200_000).selectExpr(
            "CASE WHEN id % 50 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-01-02' END AS date", "id AS v", "uuid() AS u")
        target.replace_days(big, day("2024-01-01"), day("2024-01-03"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert len(target.read(day("2024-01-02"), day("2024-01-03")).inputFiles()) > 4
    assert target.read().select("v").distinct().count() == 200_000


# ------------------------------------------------------------ series store -----

def series_rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_day_ranges():
    days = [day("2024-01-31"), day("2024-02-01"), day("2024-02-05")]
    assert day_ranges(days) == [(day("2024-01-31"), day("2024-02-02")), (day("2024-02-05"), day("2024-02-06"))]
    assert day_ranges([]) == []


@pytest.mark.parametrize("by_day", [True, False])
def test_store_follows_late_and_removed_rows(spark, by_day):
    since, until = dt.date(1998, 2, 1), dt.date(1998, 4, 10)
    folder = scratch_path(spark, "t-facts")
    write_facts(standin_inputs(TableSet(spark, SF_SMOKE), since, until=until), folder, by_day=by_day)
    facts, store = FactFolder(spark, folder), SeriesStore(spark, scratch_path(spark, "t-series"))

    def full():
        return series_rows(metric_series(spark, read_facts(spark, folder), since))

    first = store.sync(facts)
    assert len(first["card_daily"]) > 60 and series_rows(store.series(since)) == full()
    assert store.sync(facts) == {} and len(store.table.versions()) == 1
    before = full()
    add_late_rows(facts)
    assert store.sync(facts) == {"card_daily": [LATE_REPORT], "fee_rows": [LATE_FEES]}
    after = series_rows(store.series(since))
    assert after == full() and after != before
    # the late report moved the month-to-date figures of later days, which were not recomputed
    moved = {r[0] for r in set(after) - set(before) if r[1] == 0}
    assert max(moved) > LATE_REPORT and min(moved) == LATE_REPORT
    assert series_rows(store.series(since, dt.date(1998, 3, 1))) == [r for r in after if r[0] < dt.date(1998, 3, 1)]
    plan = facts.read("fee_rows", day_ranges([LATE_FEES]))._jdf.queryExecution().executedPlan().toString()
    if by_day:
        assert re.search(r"PartitionFilters: \[[^\]]*>= 1998-04-03[^\]]*< 1998-04-04", plan), plan
        gone = f"{folder}/card_daily/date={LATE_REPORT}"
        commits.remove_paths(spark, [gone])
        assert store.sync(facts, since) == {"card_daily": [LATE_REPORT]}
        assert series_rows(store.series(since)) == full()
    else:
        assert re.search(r"PushedFilters: \[[^\]]*created_at[^\]]*1998-04-03", plan), plan


def test_run_from_the_store_reads_only_the_store(spark):
    tables = TableSet(spark, SF_SMOKE)
    folder, store = scratch_path(spark, "t-facts"), SeriesStore(spark, scratch_path(spark, "t-series"))
    with pytest.raises(ValueError):
        store.series()
    write_facts(standin_inputs(tables, dt.date(1997, 12, 1), until=dt.date(1998, 4, 20)), folder)
    store.sync(FactFolder(spark, folder))
    out = run_day(spark, store, "1998-04-15", as_of="1998-04-20")
    want = run_day(spark, tables, "1998-04-15", as_of="1998-04-20")
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    files = store.series(dt.date(1998, 1, 1)).inputFiles()
    assert files and all("/month=1998-" in f and folder not in f for f in files)


# --------------------------------------------------------------- backfill ------

def test_backfill_goes_on_after_it_was_killed(spark, monkeypatch):
    tables = TableSet(spark, SF_SMOKE)
    target = CommittedTable(spark, scratch_path(spark, "t-backfill"))
    real, done = pipeline.forecast_days, []

    def killed(session, inputs, lo, hi, *args):
        if len(done) == 1:
            raise KeyboardInterrupt
        done.append(lo)
        return real(session, inputs, lo, hi, *args)

    with monkeypatch.context() as m:
        m.setattr(pipeline, "forecast_days", killed)
        with pytest.raises(KeyboardInterrupt):
            backfill_in_pieces(spark, tables, "1998-03-01", "1998-04-01", target, run="r1")
    assert max(target.parts()) == dt.date(1998, 2, 28)  # February is there, whole
    first = target.parts()
    out = backfill_in_pieces(spark, tables, "1998-03-01", "1998-04-01", target, run="r1")
    want = backfill(spark, tables, "1998-03-01", "1998-04-01")
    assert sorted(map(str, out.collect())) == sorted(map(str, want.select(*OUTPUT_COLUMNS).collect()))
    assert {d: f for d, f in target.parts().items() if d < dt.date(1998, 3, 1)} == first  # not written again
    assert len(target.ledger()) == 2
    monkeypatch.setattr(pipeline, "forecast_days", killed)
    backfill_in_pieces(spark, tables, "1998-03-01", "1998-04-01", target, run="r1")  # nothing left to do
    with pytest.raises(KeyboardInterrupt):  # a new run does everything anew
        backfill_in_pieces(spark, tables, "1998-03-01", "1998-04-01", target, run="r2")
