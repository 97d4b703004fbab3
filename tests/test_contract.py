"""The contract of the facts: what is set aside, why, and what stays."""
import json

import pytest
from conftest import SF_SMOKE, D, day

from pacecast.plans.series_store import FactFolder
from pacecast.session import scratch_path
from pacecast.sources.contract import FACT_KEYS, ContractError, check_facts, check_rows
from pacecast.sources.standins import FACT_COLUMNS, FACT_TIMES, write_facts, standin_inputs
from pacecast.sources.tables import TableSet

CODED = FACT_COLUMNS["entry_type_daily"]
KEY = FACT_KEYS["entry_type_daily"]


def reasons(bad):
    return sorted((r["reason"], r["copies"], json.loads(r["row"]).get("volume")) for r in bad.collect())


def test_reasons_and_what_stays(spark):
    d = day("2024-01-01")
    one = (d, 71, D(1), D(1), D(0), D(0))
    rows = spark.createDataFrame([
        one, one, one,                                       # kept once, two copies aside
        (d, 73, D(2), D(2), None, D(0)),                     # nulls outside the key are fine
        (None, 73, D(3), D(2), D(0), D(0)), (d, None, D(4), D(2), D(0), D(0)),
        (d, 64, D(5), D(2), D(0), D(0)), (d, 64, D(6), D(2), D(0), D(0)), (d, 64, D(6), D(2), D(0), D(0)),
    ], CODED).selectExpr("*", "'x' AS reason", "1 AS _n", "2 AS row")  # columns of the same names are ignored
    good, bad = check_rows("entry_type_daily", rows, KEY)
    assert good.columns == rows.columns[:6]
    assert sorted(r["volume"] for r in good.collect()) == [D(1), D(2)]
    assert reasons(bad) == [("conflicting key", 1, 5.0), ("conflicting key", 2, 6.0), ("no member: type_code", 1, 4.0),
                            ("no time", 1, 3.0), ("repeated row", 2, 1.0)]
    good, bad = check_rows("entry_type_daily", rows, None)  # without a key nothing is compared, no member asked for
    assert (good.count(), [r["reason"] for r in bad.collect()]) == (8, ["no time"])
    good, bad = check_rows("entry_type_daily", rows.limit(0), KEY)
    assert (good.count(), bad.count()) == (0, 0)


def test_types(spark):
    rows = spark.createDataFrame([("2024-01-01", "71", 1.5, "1", 2, 3.0), ("2024-01-02", "x", 1.5, "1", 2, 3.0),
                                  ("2024-01-03", "71", 1.255, "1", 2, 3.0), ("when", "71", 1.5, "1", 2, 3.0),
                                  ("2024-01-05", "71", 1.5, "1e30", 2, 3.0)],
                                 "date string, type_code string, volume double, volume_mtd string, fee long, fee_mtd double")
    good, bad = check_rows("entry_type_daily", rows, KEY)
    assert [tuple(r) for r in good.collect()] == [(day("2024-01-01"), 71, D("1.5"), D(1), D(2), D(3))]
    assert sorted(r["reason"] for r in bad.collect()) == [
        "unreadable: date", "unreadable: type_code", "unreadable: volume", "unreadable: volume_mtd"]
    with pytest.raises(ContractError):
        check_rows("entry_type_daily", rows.drop("fee"), KEY)


def test_counts(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 05:00:00' AS hour, 1 AS group_id, id AS company_id, "
                     "CASE id WHEN 1 THEN -1 WHEN 2 THEN 9 ELSE 1 END AS users_hourly, 5 AS users_mtd, "
                     "CASE id WHEN 3 THEN 9 END AS tx_hourly, 5 AS tx_mtd FROM range(5)")
    good, bad = check_rows("bill_hourly", rows, FACT_KEYS["bill_hourly"])
    assert sorted(r["company_id"] for r in good.collect()) == [0, 4]
    assert sorted(r["reason"] for r in bad.collect()) == [
        "above month to date: tx_hourly", "above month to date: users_hourly", "negative: users_hourly"]


@pytest.mark.parametrize("by_day", [False, True])
def test_clean_facts_pass_whole_and_quarantine_is_replaced(spark, by_day):
    folder, aside = scratch_path(spark, "t-facts"), scratch_path(spark, "t-aside")
    write_facts(standin_inputs(TableSet(spark, SF_SMOKE), day("1998-03-01"), until=day("1998-03-08")), folder, by_day)
    checked = check_facts(spark, folder, quarantine=aside)
    assert checked.bad.count() == 0 and set(checked.facts) == set(FACT_TIMES)
    for name, good in checked.facts.items():
        assert good.count() == FactFolder(spark, folder).read(name).count()  # some facts have no rows, by day no files
    if not by_day:
        spark.read.parquet(f"{folder}/card_daily").write.mode("append").parquet(f"{folder}/card_daily2")
        twice = spark.read.parquet(f"{folder}/card_daily2")
        twice.selectExpr("date", "CAST(online_volume + 1 AS DECIMAL(20,2)) AS online_volume", "offline_volume", "online_count",
                         "offline_count").write.mode("append").parquet(f"{folder}/card_daily")
        n = twice.count()
        assert check_facts(spark, folder, quarantine=aside).facts["card_daily"].count() < n
        assert spark.read.parquet(aside).where("fact = 'card_daily' AND reason = 'conflicting key'").count() > 0
        assert check_facts(spark, folder, {"card_daily": None}).facts["card_daily"].count() == 2 * n
    with pytest.raises(ValueError):
        check_facts(spark, folder, {"nothing": None})
