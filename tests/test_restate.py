"""Restating realised values, errors and accuracy of stored forecast rows."""
import datetime as dt

import pytest
from conftest import SF_SMOKE, day
from pyspark.sql import functions as F

from pacecast.plans import restate as module
from pacecast.plans.pipeline import OUTPUT_COLUMNS, run_day
from pacecast.plans.queries import add_late_fees
from pacecast.plans.restate import months_span, restate
from pacecast.plans.series_store import FactFolder, SeriesStore, _within, day_ranges
from pacecast.session import scratch_path
from pacecast.sources.commits import CommittedTable, StaleRead
from pacecast.sources.standins import standin_inputs, write_facts
from pacecast.sources.tables import TableSet

END = dt.date(1998, 3, 31)
ISSUED = [c for c in OUTPUT_COLUMNS if not c.startswith(("err_", "acc_", "linear_err")) and c != "eop_realised"]


@pytest.fixture(scope="module")
def facts_folder(spark):
    folder = scratch_path(spark, "t-restate-facts")
    write_facts(standin_inputs(TableSet(spark, SF_SMOKE), dt.date(1997, 11, 1), until=dt.date(1998, 4, 20)), folder)
    return folder


def rows(frame, columns=OUTPUT_COLUMNS):
    return sorted(map(str, frame.select(*columns).collect()))


def test_months_span():
    assert months_span({}) is None and months_span([]) is None
    assert months_span({"a": [day("1998-03-31")], "b": [day("1997-12-05")]}) == (day("1997-12-01"), day("1998-04-01"))


def test_many_ranges_are_one_flat_condition(spark):
    days = [dt.date(1990, 1, 1) + dt.timedelta(days=2 * k) for k in range(3000)]
    frame = spark.sql("SELECT explode(sequence(DATE '1989-12-01', DATE '2008-01-01', INTERVAL 1 DAY)) AS date")
    got = [r["date"] for r in frame.where(_within("date", "date", day_ranges(days))).collect()]
    assert sorted(got) == days
    stamps = frame.select((F.col("date").cast("timestamp_ntz") + F.expr("INTERVAL 5 HOURS")).alias("t"))
    assert stamps.where(_within("t", "timestamp_ntz", day_ranges(days))).count() == len(days)


def test_late_month_end_and_next_months_accuracy(spark, facts_folder, monkeypatch):
    facts, store = FactFolder(spark, facts_folder), SeriesStore(spark, scratch_path(spark, "t-series"))
    target = CommittedTable(spark, scratch_path(spark, "t-restate"))
    assert restate(spark, TableSet(spark, SF_SMOKE), target, dt.date(1998, 3, 1), dt.date(1998, 4, 1)) == []
    store.sync(facts)
    run_day(spark, store, "1998-04-01", target=target)
    run_day(spark, store, "1998-04-15", target=target)
    before, parts = target.read().cache(), target.parts()
    before.count()
    span = (dt.date(1998, 3, 1), dt.date(1998, 4, 1))
    assert restate(spark, store, target, *span) == [] and target.parts() == parts  # nothing moved
    with pytest.raises(ValueError):
        restate(spark, store, target, dt.date(1998, 3, 2), span[1])
    add_late_fees(facts, dt.date(1998, 3, 1), END)
    changed = store.sync(facts)
    assert months_span(changed) == span
    # another writer stores a judged day between the reading and the commit: it is read again
    real, waiting = CommittedTable.replace, [True]

    def replace(self, *args, **kw):
        if waiting:
            waiting.clear()
            one = target.read(dt.date(1998, 3, 5), dt.date(1998, 3, 6))
            real(target, one, lambda d: d == dt.date(1998, 3, 5))
        return real(self, *args, **kw)

    monkeypatch.setattr(module.CommittedTable, "replace", replace)
    written = restate(spark, store, target, *span)
    monkeypatch.undo()
    assert written == [dt.date(1998, 3, d) for d in range(1, 32)] + [dt.date(1998, 4, 14)]
    after = target.read()
    assert rows(after, ISSUED) == rows(before, ISSUED)  # published figures stay
    # equal to the close and the run computed anew wherever the late day changes no published figure
    again = CommittedTable(spark, scratch_path(spark, "t-restate"))
    run_day(spark, store, "1998-04-01", target=again)
    run_day(spark, store, "1998-04-15", target=again)
    march = (F.col("date") < F.lit(END))
    assert rows(after.where(march), [c for c in OUTPUT_COLUMNS if not c.startswith("acc_")]) == rows(
        again.read().where(march), [c for c in OUTPUT_COLUMNS if not c.startswith("acc_")])
    april = ["date", "feature", "measure", "acc_prev_m1", "acc_prev_linear"]
    assert rows(after.where("date = '1998-04-14'"), april) == rows(again.read().where("date = '1998-04-14'"), april)
    assert rows(after.where("date = '1998-04-14'"), april) != rows(before.where("date = '1998-04-14'"), april)
    # March looks back to a February that was never stored: its accuracy stays as it was
    assert rows(after.where(march), ["date", "feature", "acc_prev_m1"]) == rows(
        before.where(march), ["date", "feature", "acc_prev_m1"])
    assert restate(spark, store, target, *span) == []
    # a month end whose rows are gone opens the month again
    opened = restate(spark, store, target, *span, as_of=END)
    assert opened[0] == dt.date(1998, 3, 1)
    row = target.read().where("date = '1998-03-10' and feature = 0").agg(
        F.count("eop_realised").alias("n"), F.max("err_rate_m1").alias("r"), F.count("err_m1").alias("e")).first()
    assert (row["n"], row["r"], row["e"]) == (0, 0, 0)


def test_commit_made_of_replaced_parts_is_refused(spark):
    table = CommittedTable(spark, scratch_path(spark, "t-stale"))
    one = spark.createDataFrame([(day("2024-01-01"), 1)], "date date, v int")
    table.replace(one, lambda d: True)
    seen = table.parts()
    table.replace(one, lambda d: True)
    with pytest.raises(StaleRead):
        table.replace(one, lambda d: True, expect=seen)
    with pytest.raises(StaleRead):
        table.replace(one, lambda d: True, expect={day("2024-01-01"): None})
    table.replace(one, lambda d: True, expect={**table.parts(), day("2024-01-02"): None})
    assert len(table.versions()) == 3
