import datetime as dt
import random
from collections import defaultdict

from conftest import D, day

from pacecast.operators.series import (CubeSlice, CodedMetric, PairTotal, coded_series,
                                       cube_slice_series, hourly_peak_series, month_to_date,
                                       pair_total_series, row_fee_series)
from pacecast.sources.standins import ALL


def brute_mtd(rows):
    """rows: (key, ts, value) -> {(key, date): (max value, max running sum with peers)}."""
    out = {}
    by_month = defaultdict(list)
    for k, ts, v in rows:
        by_month[(k, ts.year, ts.month)].append((ts, v))
    for (k, _, _), items in by_month.items():
        for ts, v in items:
            run = sum((x or 0) for t, x in items if t <= ts)
            key = (k, ts.date() if isinstance(ts, dt.datetime) else ts)
            pv, pp = out.get(key, (None, None))
            pv = v if pv is None else (pv if v is None else max(pv, v))
            pp = run if pp is None else max(pp, run)
            out[key] = (pv, pp)
    return out


def test_month_to_date_timestamps_with_ties_and_negatives(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        ts = dt.datetime(2024, rnd.choice([1, 2]), rnd.randint(1, 28), rnd.choice([0, 9, 23]),
                         rnd.choice([0, 30, 59]), rnd.choice([0, 1]))
        v = None if rnd.random() < 0.05 else D(round(rnd.uniform(-50, 100), 2))
        rows.append((rnd.choice(["a", "b"]), ts, v))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v decimal(20,2)")
    got = {(r["k"], r["date"]): (r["value"], r["value_ptd"])
           for r in month_to_date(df, ["k"], "ts", "v").collect()}
    assert got == brute_mtd(rows)


def test_month_to_date_date_grain(spark):
    rows = [("a", day("2024-01-01"), D(1)), ("a", day("2024-01-01"), D(2)),
            ("a", day("2024-01-03"), D(5)), ("a", day("2024-02-01"), D(7))]
    df = spark.createDataFrame(rows, "k string, d date, v decimal(20,2)")
    got = {r["date"]: (r["value"], r["value_ptd"])
           for r in month_to_date(df, ["k"], "d", "v").collect()}
    assert got == {day("2024-01-01"): (D(2), D(3)), day("2024-01-03"): (D(5), D(8)),
                   day("2024-02-01"): (D(7), D(7))}


def test_pair_totals_null_side_counts_as_zero(spark):
    df = spark.createDataFrame(
        [(day("2024-01-01"), D(10), None), (day("2024-01-02"), None, None),
         (day("2024-01-03"), D(1.5), D(2.25))],
        "date date, a decimal(20,2), b decimal(20,2)")
    out = pair_total_series(df, [PairTotal(0, 5, 2, "a", "b")]).orderBy("date").collect()
    assert [(r["value"], r["value_ptd"]) for r in out] == [
        (D("10.00"), D("10.00")), (D("0.00"), D("10.00")), (D("3.75"), D("13.75"))]
    assert {(r["feature"], r["measure"], r["entity"]) for r in out} == {(0, 5, 2)}


def test_coded_series_code_feeds_two_metrics_and_in_list(spark):
    df = spark.createDataFrame(
        [(day("2024-01-01"), 71, D(1), D(1), D(10), D(10)),
         (day("2024-01-01"), 73, D(2), D(2), D(20), D(20)),
         (day("2024-01-01"), 99, D(5), D(5), D(5), D(5))],
        "date date, type_code int, volume decimal(20,2), volume_mtd decimal(20,2), "
        "fee decimal(20,2), fee_mtd decimal(20,2)")
    metrics = [CodedMetric(1, 5, 0, (71, 73), "volume", "volume_mtd"),
               CodedMetric(9, 6, 0, (73,), "fee", "fee_mtd")]
    got = {(r["feature"], r["measure"]): (r["value"], r["value_ptd"])
           for r in coded_series(spark, df, metrics).collect()}
    assert got == {(1, 5): (D(3), D(3)), (9, 6): (D(20), D(20))}


def test_cube_slices_take_absolute_net_volume(spark):
    cols = ("date date, acceptor_id int, category_id int, is_abroad int, is_offline int, "
            "net_volume_daily decimal(20,2), net_volume_mtd decimal(20,2), users_daily bigint, "
            "users_mtd bigint, tx_daily bigint, tx_mtd bigint")
    d = day("2024-01-02")
    df = spark.createDataFrame([
        (d, ALL, ALL, ALL, 1, D(-5), D(-8), 3, 4, 7, 9),
        (d, ALL, ALL, 1, 1, D(2), D(2), 1, 1, 1, 1),
        (d, 1, ALL, ALL, 1, D(100), D(100), 9, 9, 9, 9),   # acceptor not rolled up: ignored
    ], cols)
    got = {(r["feature"], r["measure"]): (r["value"], r["value_ptd"])
           for r in cube_slice_series(spark, df, [CubeSlice(9, ALL, 1), CubeSlice(14, 1, 1)]).collect()}
    assert got == {(9, 5): (D(5), D(8)), (9, 0): (D(3), D(4)), (9, 4): (D(7), D(9)),
                   (14, 5): (D(2), D(2)), (14, 0): (D(1), D(1)), (14, 4): (D(1), D(1))}


def test_hourly_peak_is_busiest_hour(spark):
    cols = "feature int, hour timestamp_ntz, group_id int, company_id int, users_hourly bigint, " \
           "users_mtd bigint, tx_hourly bigint, tx_mtd bigint"
    df = spark.createDataFrame([
        (5, dt.datetime(2024, 1, 1, 9), ALL, ALL, 3, 3, 10, 10),
        (5, dt.datetime(2024, 1, 1, 10), ALL, ALL, 5, 6, 4, 14),
        (5, dt.datetime(2024, 1, 1, 11), 1, ALL, 50, 60, 40, 140),
    ], cols)
    got = {r["measure"]: (r["value"], r["value_ptd"]) for r in hourly_peak_series(df).collect()}
    assert got == {0: (D(5), D(6)), 4: (D(10), D(14))}


def test_row_fee_series_ties_are_peers(spark):
    ts = dt.datetime(2024, 1, 5)
    df = spark.createDataFrame([(ts, D(3)), (ts, D(4)), (dt.datetime(2024, 1, 6), None)],
                               "created_at timestamp_ntz, fee decimal(20,2)")
    got = {r["date"]: (r["value"], r["value_ptd"]) for r in row_fee_series(df, 3, 6, 2).collect()}
    assert got == {day("2024-01-05"): (D(4), D(7)), day("2024-01-06"): (D(0), D(7))}


def test_ptd_at_month_end_is_the_month_sum(spark):
    from conftest import SF_SMOKE
    from pyspark.sql import functions as F
    from pacecast.functions.decimals import money
    li = spark.read.parquet(f"{SF_SMOKE}/lineitem.parquet").select(
        "l_returnflag", "l_shipdate", money("l_extendedprice").alias("price"))
    mtd = month_to_date(li, ["l_returnflag"], "l_shipdate", "price")
    last = (mtd.groupBy("l_returnflag", F.trunc("date", "MM").alias("m"))
            .agg(F.max_by("value_ptd", "date").alias("ptd_end")))
    sums = (li.groupBy("l_returnflag", F.trunc(F.to_date("l_shipdate"), "MM").alias("m"))
            .agg(F.sum("price").alias("total")))
    joined = last.join(sums, ["l_returnflag", "m"], "full")
    assert joined.filter(F.col("ptd_end").isNull() | F.col("total").isNull()
                         | (F.col("ptd_end") != F.col("total"))).count() == 0


def test_hourly_cube_users_mtd_with_a_hot_user(spark):
    import random
    from pacecast.sources.standins import ALL, EVENT_FEATURE, hourly_cube
    rnd = random.Random(3)
    types = sorted(EVENT_FEATURE)
    rows = []
    for i in range(600):
        user = 7 if rnd.random() < 0.6 else rnd.randint(1, 40)       # one user holds most rows
        ts = dt.datetime(2024, rnd.choice([1, 2]), rnd.randint(1, 3), rnd.randint(0, 23), rnd.randint(0, 59))
        rows.append((i, ts, user, rnd.choice(types), 1.0, ""))
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, "
                                         "event_type string, value double, props string")
    got = {(r["feature"], r["hour"]): (r["users_hourly"], r["users_mtd"], r["tx_hourly"], r["tx_mtd"])
           for r in hourly_cube(events, full=False).collect()
           if r["group_id"] == ALL and r["company_id"] == ALL}
    want = {}
    for f in set(EVENT_FEATURE.values()):
        mine = [(ts.replace(minute=0), u) for _, ts, u, t, _, _ in rows if EVENT_FEATURE[t] == f]
        for hour in {h for h, _ in mine}:
            in_hour = [u for h, u in mine if h == hour]
            to_date = [u for h, u in mine if h <= hour and (h.year, h.month) == (hour.year, hour.month)]
            want[(f, hour)] = (len(set(in_hour)), len(set(to_date)), len(in_hour), len(to_date))
    assert got == want


def test_month_to_date_beyond_64_bit_cents(spark):
    """Sums and single values of decimal(20,2) that don't fit in 64-bit cents."""
    fees = [(dt.datetime(2024, 1, 1, h), D("60000000000000000.00")) for h in range(3)]
    fees.append((dt.datetime(2024, 2, 1), D("100000000000000000.00")))
    df = spark.createDataFrame(fees, "created_at timestamp_ntz, fee decimal(20,2)")
    got = {r["date"]: (r["value"], r["value_ptd"]) for r in row_fee_series(df, 3, 6, 2).collect()}
    assert got == {day("2024-01-01"): (D("60000000000000000.00"), D("180000000000000000.00")),
                   day("2024-02-01"): (D("100000000000000000.00"),) * 2}


def test_month_to_date_of_many_decimals(spark):
    tiny = D("0.00000000000000000001")
    rows = [("a", dt.datetime(2024, 1, d, h), D("1.5") + tiny) for d in (1, 2) for h in (0, 1)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v decimal(26,20)")
    got = {r["date"]: r["value_ptd"] for r in month_to_date(df, ["k"], "ts", "v").collect()}
    assert got == {day("2024-01-01"): D("3") + 2 * tiny, day("2024-01-02"): D("6") + 4 * tiny}


def test_fees_are_cast_after_the_sum(spark):
    rows = [(dt.datetime(2024, 1, 1, h), D("0.0050")) for h in range(3)]
    df = spark.createDataFrame(rows, "created_at timestamp_ntz, fee decimal(20,4)")
    row = row_fee_series(df, 3, 6, 2).collect()[0]
    assert (row["value"], row["value_ptd"]) == (D("0.01"), D("0.02"))


def test_rolled_down_members_are_left_out(spark):
    """One rolled-down row for each of the four member filters."""
    cube = spark.createDataFrame(
        [(day("2024-01-01"), a, c, 0, ALL, 1, 1, 1, 1, D(v), D(v))
         for a, c, v in ((ALL, ALL, 1), (5, ALL, 10), (ALL, 5, 100))],
        "date date, acceptor_id int, category_id int, is_abroad int, is_offline int, users_daily long, "
        "users_mtd long, tx_daily long, tx_mtd long, net_volume_daily decimal(20,2), net_volume_mtd decimal(20,2)")
    got = cube_slice_series(spark, cube, [CubeSlice(11, 0, ALL)]).where("measure = 5").collect()
    assert [r["value"] for r in got] == [D(1)]
    hourly = spark.createDataFrame(
        [(5, dt.datetime(2024, 1, 1), g, c, v, v, v, v) for g, c, v in ((ALL, ALL, 1), (5, ALL, 10), (ALL, 5, 100))],
        "feature int, hour timestamp_ntz, group_id int, company_id int, users_hourly long, users_mtd long, "
        "tx_hourly long, tx_mtd long")
    assert {r["value"] for r in hourly_peak_series(hourly).collect()} == {D(1)}


def test_forecast_cube_is_the_full_cube_rolled_up(spark):
    from conftest import SF_SMOKE

    from pacecast.sources.standins import acceptor_cube
    from pacecast.sources.tables import TableSet
    t = TableSet(spark, SF_SMOKE)
    tables = (t.lineitem, t.orders, t.customer, t.supplier)
    full = acceptor_cube(*tables, full=True).where((f"acceptor_id = {ALL} and category_id = {ALL}"))
    cube = acceptor_cube(*tables, full=False)
    assert [f.dataType for f in cube.schema] == [f.dataType for f in full.schema]
    assert cube.exceptAll(full).isEmpty() and full.exceptAll(cube).isEmpty()


def _cube_tables(spark, rows):
    """Tables of line items (day, supplier, customer, line status, return flag, price), an order each."""
    lines = [(k, s, float(p), status, flag, dt.datetime.fromisoformat(d) if d else None)
             for k, (d, s, _, status, flag, p) in enumerate(rows)]
    return (spark.createDataFrame(lines, "l_orderkey long, l_suppkey long, l_extendedprice double, l_linestatus string, "
                                         "l_returnflag string, l_shipdate timestamp_ntz"),
            spark.createDataFrame([(k, r[2]) for k, r in enumerate(rows)], "o_orderkey long, o_custkey long"),
            spark.createDataFrame([(c, c % 2, ("BUILDING", "MACHINERY", None)[c % 3]) for c in {r[2] for r in rows}],
                                  "c_custkey long, c_nationkey int, c_mktsegment string"),
            spark.createDataFrame([(s, 0) for s in {r[1] for r in rows}], "s_suppkey long, s_nationkey int"))


def test_acceptor_cube_matches_model(spark, monkeypatch):
    """All 16 sets against sets of users in Python, with acceptors dealt by month and by users."""
    from pacecast.sources import standins

    chance = random.Random(5)
    rows = [(chance.choice(["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02"]), chance.choice([1, 1, 1, 2, 3]),
             chance.randrange(6), chance.choice("FO"), chance.choice("RN"), chance.randrange(1, 9)) for _ in range(120)]
    want = {}
    for sets in standins.acceptor_grouping_sets(True):
        daily = {}
        for d, s, c, status, flag, p in rows:
            member = {"acceptor_id": s, "category_id": (2, 5, None)[c % 3], "is_abroad": c % 2,
                      "is_offline": int(status == "F")}
            key = tuple(member[m] if m in sets else standins.ALL for m in standins.ACCEPTOR_DIMS)
            users, net = daily.setdefault((key, d), (set(), []))
            users.add(c)
            net.append(-p if flag == "R" else p)
        for (key, d), (users, net) in daily.items():
            month = [v for (k, e), v in daily.items() if k == key and e[:7] == d[:7] and e <= d]
            want[(dt.date.fromisoformat(d), *key)] = (
                len(users), len(set().union(*(u for u, _ in month))), len(net), sum(len(n) for _, n in month),
                sum(net), sum(sum(n) for _, n in month))
    tables = _cube_tables(spark, rows)
    for hot_rows in (standins.HOT_ROWS, 20):
        monkeypatch.setattr(standins, "HOT_ROWS", hot_rows)
        got = standins.acceptor_cube(*tables, full=True).collect()
        assert len(got) == len(want) and {tuple(r)[:5]: tuple(r)[5:] for r in got} == want


def test_acceptor_cube_copies_are_not_shuffled(spark):
    """Eight of the 16 copies of a row, those with its acceptor, are aggregated where they are made."""
    from pacecast.sources.standins import acceptor_cube

    cube = acceptor_cube(*_cube_tables(spark, [("2024-01-30", 1, 1, "F", "N", 1), ("2024-01-31", 2, 2, "O", "R", 2)]))
    own = cube._jdf.queryExecution().executedPlan().toString().split("Union")[1]
    assert "Exchange" not in own[:own.index("Generate")]


def _cube_of(spark, rows):
    """All 16 sets of detail rows (day, acceptor, category, abroad, offline, customer, net), as made by windows."""
    from pyspark.sql import functions as F

    from pacecast.sources import standins

    detail = spark.createDataFrame(rows, "date date, acceptor_id int, category_id int, is_abroad int, is_offline int, "
                                         "o_custkey long, net decimal(20,2)").withColumn("_month", F.trunc("date", "MM"))
    want = standins._cube_with_month_to_date(
        detail.withColumn("_tx", F.lit(1)), "date", standins.ACCEPTOR_DIMS, standins.acceptor_grouping_sets(True),
        "o_custkey", {"net_volume_daily": "net"}, [], ["_month", "o_custkey"])
    return detail, want.withColumn("users_daily", F.when(F.col("date").isNotNull(), F.col("users_daily")))


def test_cube_in_arrays_matches_windows(spark, monkeypatch):
    """Null days, members, users and nets, sums beyond a long, customers of several rows a day; in many blocks."""
    from pacecast.operators import slices
    from pacecast.sources import standins

    chance = random.Random(11)
    days = [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 2, 29), None]
    nets = [D("0.01"), D("-2.50"), D("9999999999999999.99"), D("-999999999999999.99"), None]
    rows = [(chance.choice(days), chance.choice([1, 2, standins.ALL, -7]), chance.choice([1, 5, None]), chance.choice([0, 1, None]),
             chance.choice([0, 1, None]), chance.choice([3, 4, 5, 2 ** 40, None]), chance.choice(nets)) for _ in range(400)]
    rows.append((days[0], 1, 1, 0, 0, 3, D("123456789012345678.91")))
    detail, want = _cube_of(spark, rows)
    monkeypatch.setattr(slices, "BLOCK_ROWS", 32)
    for hot_rows, task_rows in ((standins.HOT_ROWS, 50), (10, 1000)):
        monkeypatch.setattr(standins, "HOT_ROWS", hot_rows)
        monkeypatch.setattr(standins, "TASK_ROWS", task_rows)
        got = standins._acceptor_day_cube(detail.drop("_month"))
        # supplier 10000 shares its key with "all" but has rows of its own
        assert sorted(map(str, got.where("acceptor_id <> 10000").collect())) == sorted(
            map(str, want.where("acceptor_id <> 10000").select(*got.columns).collect()))
        others = [r for r in rows if r[1] != standins.ALL]
        alone, expected = _cube_of(spark, others)
        assert sorted(map(str, standins._acceptor_day_cube(alone.drop("_month")).collect())) == sorted(
            map(str, expected.select(*got.columns).collect()))


def test_acceptor_cube_is_rolled_up_without_rows_per_copy(spark):
    """No copy of a row is a Spark row that is sorted or aggregated; filters by acceptor reach the stored detail."""
    from pyspark.sql import functions as F

    from pacecast.sources import standins

    chance = random.Random(3)
    rows = [(chance.choice(["2024-01-30", "2024-02-01"]), chance.choice([1, 2]), chance.randrange(4), chance.choice("FO"),
             "N", chance.randrange(1, 9)) for _ in range(40)]
    cube = standins.acceptor_cube(*_cube_tables(spark, rows), full=True)
    all_rows = cube.collect()
    assert cube.count() == len(all_rows) == cube.groupBy().agg(F.count("users_daily")).first()[0]
    plan = cube._jdf.queryExecution().optimizedPlan().toString()
    own = [l for l in plan.split("\n") if l.startswith(":")]  # the first of the union's parts
    assert not any(word in l for l in own for word in ("Sort", "Aggregate", "Window"))
    assert sum("ArrowEvalPython" in l for l in own) == 1
    assert "lambdafunction" not in plan
    one = cube.where("acceptor_id = 1")
    assert sorted(map(str, one.collect())) == sorted(str(r) for r in all_rows if r["acceptor_id"] == 1)
    scans = [l for l in one._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in l]
    assert any("acceptor_id" in l.split("PushedFilters")[1] and "EqualTo(acceptor_id,1)" in l for l in scans)
