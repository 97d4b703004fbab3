"""Stand-in source tables built from the test tables (see FIXTURES.md).

The forecast reads seven metric facts that the test data does not have.
Each builder derives one of them from the TPC-H-ish tables with ordinary
DataFrame work (filters, joins, grouping sets, month windows) so that the
inputs grow with the data. Every builder takes ``since`` (a month start):
rows before it are cut at the scan, which leaves month-to-date figures of
later months unchanged.

Money columns are cast to decimal(20,2) *before* summing; the source
doubles carry at most two decimals.
"""

from __future__ import annotations

import datetime as dt
import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.decimals import MONEY, money
from ..operators.slices import cube_rows, users_by_day
from ..session import materialize
from .tables import TableSet

# ----------------------------------------------------------------------------
# Fixed values. The entry-type codes and the "all members" marker must equal
# the reference's for the branch filters to select the same rows.
# l_suppkey % 10 = 0..9 maps, in order, to entry-type codes:
ENTRY_TYPE_CODES = [71, 73, 64, 29, 28, 30, 31, 91, 14, 15]
ALL = 10000
# Stand-in member codes (our choice, alphabetical):
SEGMENT_CODES = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
EVENT_TYPE_CODES = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
# Which hourly cube (by feature: 5 bill, 6 game, 7 travel card) an event feeds.
EVENT_FEATURE = {"click": 6, "error": 7, "purchase": 5, "signup": 7, "view": 6}
# ----------------------------------------------------------------------------

ACCEPTOR_DIMS = ["acceptor_id", "category_id", "is_abroad", "is_offline"]
HOURLY_DIMS = ["group_id", "company_id"]


def _since_ts(since: dt.date | None) -> Column | None:
    """Midnight of ``since`` as timestamp_ntz (a date cast: no time zone involved)."""
    return None if since is None else F.lit(since).cast("timestamp_ntz")


def filter_since(df: DataFrame, ts_col: str, since: dt.date | None,
                  until: dt.date | None = None) -> DataFrame:
    """Bounds on the raw timestamp column (``since`` inclusive, ``until``
    exclusive), so they reach the Parquet scan."""
    bound = _since_ts(since)
    if bound is not None:
        df = df.filter(F.col(ts_col) >= bound)
    if until is not None:
        df = df.filter(F.col(ts_col) < _since_ts(until))
    return df


def _month(col: str) -> Column:
    return F.trunc(F.col(col), "MM")


def _lookup(mapping: dict, key: str) -> Column:
    """``CASE key WHEN 'k' THEN v ... END`` (NULL for an unknown key)."""
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in mapping.items())
    return F.expr(f"CASE {key} {whens} END")


# ------------------------------------------------------------ card_daily -----

def card_daily(lineitem: DataFrame, since: dt.date | None = None,
               until: dt.date | None = None) -> DataFrame:
    """Daily card report: online ('O') and offline ('F') volume and count.

    A side absent on a day is NULL, as in a report table.
    """
    li = filter_since(lineitem, "l_shipdate", since, until).select(
        F.to_date("l_shipdate").alias("date"),
        F.col("l_linestatus").alias("status"),
        money("l_extendedprice").alias("price"))
    online, offline = F.col("status") == "O", F.col("status") == "F"
    return li.groupBy("date").agg(
        F.sum(F.when(online, F.col("price"))).cast(MONEY).alias("online_volume"),
        F.sum(F.when(offline, F.col("price"))).cast(MONEY).alias("offline_volume"),
        F.sum(F.when(online, F.lit(1))).cast(MONEY).alias("online_count"),
        F.sum(F.when(offline, F.lit(1))).cast(MONEY).alias("offline_count"))


# ------------------------------------------------------ entry_type_daily -----

def entry_type_daily(lineitem: DataFrame, since: dt.date | None = None,
                     until: dt.date | None = None) -> DataFrame:
    """Daily volume and fee per entry-type code, with month-to-date columns."""
    daily = (filter_since(lineitem, "l_shipdate", since, until)
             .select(F.to_date("l_shipdate").alias("date"), entry_type_code().alias("type_code"),
                     money("l_extendedprice").alias("price"), money("l_quantity").alias("qty"))
             .groupBy("date", "type_code")
             .agg(F.sum("price").alias("volume"), F.sum("qty").alias("fee")))
    return entry_types_to_date(daily)


def entry_type_code() -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in ENTRY_TYPE_CODES]), (F.col("l_suppkey") % 10 + 1).cast("int"))


def entry_types_to_date(daily: DataFrame) -> DataFrame:
    """Volume and fee per (date, type_code) with their month-to-date columns."""
    mtd = (Window.partitionBy("type_code", _month("date")).orderBy("date")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.select(
        "date", "type_code", F.col("volume").cast(MONEY).alias("volume"),
        F.sum("volume").over(mtd).cast(MONEY).alias("volume_mtd"),
        F.col("fee").cast(MONEY).alias("fee"),
        F.sum("fee").over(mtd).cast(MONEY).alias("fee_mtd"))


# --------------------------------------------------------------- fee_rows ----

def fee_rows(orders: DataFrame, since: dt.date | None = None,
             until: dt.date | None = None) -> DataFrame:
    """Row-grain fee report; many rows share a timestamp (peers in a window)."""
    return filter_since(orders, "o_orderdate", since, until).select(
        F.col("o_orderdate").alias("created_at"), money("o_totalprice").alias("fee"))


# ---------------------------------------------------------- acceptor_cube ----

def acceptor_grouping_sets(full: bool) -> list[list[str]]:
    """All 16 subsets of the members, or only acceptor=ALL, category=ALL."""
    dims = ACCEPTOR_DIMS if full else ["is_abroad", "is_offline"]
    sets = []
    for r in range(len(dims), -1, -1):
        sets.extend([list(c) for c in itertools.combinations(dims, r)])
    return sets


def _spread(df: DataFrame, tasks: int | None, *keys: str | Column) -> DataFrame:
    """Rows of a key in one partition. ``tasks`` is given where each row is then copied in place: by
    the shuffled bytes alone, partitions would be joined that are small before the copies are made."""
    return df.repartition(tasks, *keys) if tasks else df.repartition(*keys)


def _cube_with_month_to_date(detail: DataFrame, time_col: str, dims: list[str],
                             sets: list[list[str]], user_col: str,
                             sums: dict[str, str], prefix: list[str], within: list[str],
                             tasks: int | None = None) -> DataFrame:
    """Grouping-set cube by ``time_col`` with distinct users, rows (sums of
    ``_tx``) and sums (outputs decimal(20,2)), each also month-to-date.

    The detail rows are shuffled once, by ``within``; each is then exploded in
    place into the slices it belongs to (rolled-up members = ALL), so that no copy
    is shuffled, and aggregated once per (time, slice, user); a
    user counts as new on its first time of the month (a window over the
    (month, slice, user) key); then per (time, slice) the
    distinct users are the row count, and the month-to-date figures are
    running sums over a (slice, month) window of at most one month of rows.
    Unique users month-to-date cannot be summed from daily figures; this
    counts each user exactly once per month and slice. ``within`` is the month and either
    the user, and the counts are aggregated before they are shuffled, or the
    prefix, and nothing else is shuffled; its keys must hold no more rows than suit one task.
    """
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{d}', CAST({d if d in s else ALL} AS INT)" for d in dims) + ")"
        for s in sets)
    members = F.expr(f"explode(array({structs}))").alias("_slice")
    inputs = list(dict.fromkeys(sums.values()))
    sliced = (_spread(detail, tasks, *within)
              .select(*prefix, time_col, "_month", user_col, "_tx", *inputs, members)
              .select(*prefix, time_col, "_month", user_col, "_tx", *inputs, "_slice.*"))
    per_user = (sliced.groupBy(*prefix, time_col, "_month", *dims, user_col)
                .agg(F.sum("_tx").alias("_tx"),
                     *[F.sum(c).alias(f"_s_{c}") for c in inputs]))
    first_seen = Window.partitionBy(*prefix, "_month", *dims, user_col)
    per_user = per_user.withColumn(
        "_new", (F.col(time_col) == F.min(time_col).over(first_seen)).cast("int"))
    daily = (per_user.groupBy(*prefix, time_col, "_month", *dims)
             .agg(F.count(F.lit(1)).alias("users_daily"),
                  F.sum("_new").alias("_new"),
                  F.sum("_tx").alias("tx_daily"),
                  *[F.sum(f"_s_{c}").alias(name) for name, c in sums.items()]))
    mtd = (Window.partitionBy(*prefix, *dims, "_month").orderBy(time_col)
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.select(
        *prefix, time_col, *dims,
        "users_daily",
        F.sum("_new").over(mtd).alias("users_mtd"),
        "tx_daily",
        F.sum("tx_daily").over(mtd).alias("tx_mtd"),
        *[c for name in sums for c in (F.col(name).cast(MONEY).alias(name),
                                       F.sum(name).over(mtd).cast(MONEY).alias(
                                           name.replace("_daily", "_mtd")))])


def day_bit(date_col: str = "date") -> Column:
    """A user's activity on a day of the month as one bit; days are united by ``bit_or``."""
    return F.expr(f"shiftleft(1, dayofmonth({date_col}) - 1)")


def _active_days(masks: str) -> Column:
    """Exploded days of the month (from 0) set in a mask expression."""
    return F.explode(F.expr(f"filter(sequence(0, 30), d -> shiftright({masks}, d) & 1 = 1)")).alias("_day")


def _day_cube(detail: DataFrame, dims: list[str], sets: list[list[str]], user_col: str,
              sums: dict[str, str], tasks: int, parts: int) -> DataFrame:
    """The grouping-set cube of :func:`_cube_with_month_to_date` at the grain of days.

    Additive figures and users are rolled up apart, both from aggregates instead of raw rows:
    the figures from one row per (day, members), the users from one 31-bit mask of active days per
    (month, members, user). A coarser slice's mask is the union of the finer ones, so a
    user is counted once per day and, on the mask's first day, once per month. Every step is
    aggregated before its shuffle, so neither a hot slice nor a hot user is one task's raw rows;
    the masks of a (month, user) are rolled up in one partition, in arrays, so their copies aren't shuffled.
    ``tasks`` do that, and the users of a month are dealt in ``parts``.
    """
    structs = ", ".join(
        "named_struct(" + ", ".join(f"'{d}', CAST({d if d in s else ALL} AS INT)" for d in dims) + ")"
        for s in sets)

    def rolled(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
        members = F.expr(f"explode(array({structs}))").alias("_slice")
        return df.select(*keys, *values, members).select(*keys, *values, "_slice.*")

    inputs = list(dict.fromkeys(sums.values()))
    cells = detail.groupBy("date", *dims).agg(F.count(F.lit(1)).alias("_tx"),
                                              *[F.sum(c).alias(f"_s_{c}") for c in inputs])
    figures = (rolled(cells, ["date"], ["_tx", *[f"_s_{c}" for c in inputs]]).groupBy("date", *dims)
               .agg(F.sum("_tx").alias("tx_daily"), *[F.sum(f"_s_{c}").alias(n) for n, c in sums.items()]))
    masks = detail.groupBy("_month", *dims, user_col).agg(F.bit_or(day_bit()).alias("_mask"))
    # a task holds few months, so that its counts are few
    masks = _spread(masks, tasks, "_month", F.pmod(F.hash(user_col), F.lit(parts)))
    users = (users_by_day(masks, "_month", dims, user_col, "_mask", sets, ALL).groupBy("_month", "_day", *dims)
             .agg(F.sum("users").alias("users_daily"), F.sum("new").alias("_new"))
             .select(F.date_add("_month", F.col("_day")).alias("date"), *dims, "users_daily", "_new"))
    # both have one row per (day, slice): put beside each other with a grouping, which keeps null members
    both = figures.unionByName(users, allowMissingColumns=True)
    daily = both.groupBy("date", *dims).agg(
        *[F.sum(c).alias(c) for c in ("users_daily", "_new", "tx_daily")],
        *[F.max(n).alias(n) for n in sums]).withColumn("_month", F.trunc("date", "MM"))
    mtd = (Window.partitionBy(*dims, "_month").orderBy("date")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.select(
        "date", *dims, "users_daily", F.sum("_new").over(mtd).alias("users_mtd"),
        "tx_daily", F.sum("tx_daily").over(mtd).alias("tx_mtd"),
        *[c for name in sums for c in (F.col(name).cast(MONEY).alias(name),
                                       F.sum(name).over(mtd).cast(MONEY).alias(
                                           name.replace("_daily", "_mtd")))])


# The (abroad, offline) cells of a day, and the slices that are unions of them.
CELLS = [(a, o) for a in (0, 1) for o in (0, 1)]
SLICES = [(a, o) for a in (0, 1, ALL) for o in (0, 1, ALL)]


def cells_within(s: tuple[int, int]) -> list[str]:
    return [f"{a}{o}" for a, o in CELLS if s[0] in (a, ALL) and s[1] in (o, ALL)]


def slice_masks() -> list[Column]:
    """A user's mask ``_s<k>`` of each slice, from the masks ``_m<cell>`` of the cells."""
    return [F.expr(" | ".join(f"_m{c}" for c in cells_within(s))).alias(f"_s{k}") for k, s in enumerate(SLICES)]


def slice_users() -> list[Column]:
    """Aggregates over (user, active ``_day``): users ``u<k>`` of each slice, and those new in the month, ``n<k>``."""
    out = []
    for k in range(len(SLICES)):
        out += [F.count(F.expr(f"CASE WHEN shiftright(_s{k}, _day) & 1 = 1 THEN 1 END")).alias(f"u{k}"),
                F.count(F.expr(f"CASE WHEN _s{k} & (shiftleft(2L, _day) - 1) = shiftleft(1, _day) THEN 1 END"))
                .alias(f"n{k}")]
    return out


def flag_slices(daily: DataFrame) -> DataFrame:
    """Cube rows of the slices, from one row a day: ``_tx<cell>`` and ``_net<cell>``, ``u<k>`` and ``n<k>``."""
    rows = ", ".join(
        f"{s[0]}, {s[1]}, u{k}, n{k}, {' + '.join(f'_tx{c}' for c in cells_within(s))}, CAST("
        f"{' + '.join(f'COALESCE(_net{c}, 0)' for c in cells_within(s))} AS DECIMAL(32,2))"
        for k, s in enumerate(SLICES))
    daily = daily.selectExpr(
        "date", "_month", f"stack({len(SLICES)}, {rows}) AS (is_abroad, is_offline, users, new, tx, net)"
    ).where("tx > 0")
    mtd = (Window.partitionBy("is_abroad", "is_offline", "_month").orderBy("date")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.select(
        "date", F.lit(ALL).alias("acceptor_id"), F.lit(ALL).alias("category_id"), "is_abroad", "is_offline",
        F.col("users").alias("users_daily"), F.sum("new").over(mtd).alias("users_mtd"),
        F.col("tx").alias("tx_daily"), F.sum("tx").over(mtd).alias("tx_mtd"),
        F.col("net").cast(MONEY).alias("net_volume_daily"),
        F.sum("net").over(mtd).cast(MONEY).alias("net_volume_mtd"))


def _flag_cube(detail: DataFrame) -> DataFrame:
    """The slices with acceptor and category rolled up, without a row per slice.

    Rows and net are columns for the four (abroad, offline) cells of a day; users have
    one 31-bit mask of active days per (month, user) and cell. A slice is a sum of cells and a
    union of masks, and a user is new to it on the first day of its mask. Both aggregations
    shrink their rows before they are shuffled.
    """
    hit = {c: (F.col("is_abroad") == c[0]) & (F.col("is_offline") == c[1]) for c in CELLS}
    figures = detail.groupBy("date").agg(
        *[F.count(F.when(hit[a, o], 1)).alias(f"_tx{a}{o}") for a, o in CELLS],
        *[F.sum(F.when(hit[a, o], F.col("net"))).alias(f"_net{a}{o}") for a, o in CELLS])
    masks = detail.groupBy("_month", "o_custkey").agg(
        *[F.coalesce(F.bit_or(F.when(hit[a, o], day_bit())), F.lit(0)).alias(f"_m{a}{o}") for a, o in CELLS])
    masks = masks.select("_month", *slice_masks())
    everything = SLICES.index((ALL, ALL))
    seen = masks.select("*", _active_days(f"_s{everything}"))
    users = (seen.groupBy("_month", "_day").agg(*slice_users())
             .withColumn("date", F.date_add("_month", F.col("_day"))))
    return flag_slices(figures.join(users, "date"))


#: Rows of an acceptor and month from which they are dealt by users instead.
HOT_ROWS = 50_000
#: Detail rows of a task that returns about eight rows of each.
TASK_ROWS = 50_000
#: Detail rows of a task that returns counts of users, and in how many parts of a month's users they come: enough
#: for tasks of like size, few enough for counts of few months.
COUNT_ROWS, COUNT_PARTS = 200_000, 8


def _acceptor_day_cube(detail: DataFrame, scratch: list[str] | None = None) -> DataFrame:
    """All 16 grouping sets of the acceptor cube, by day.

    The eight with the acceptor have about a row per detail row each. They are made where the rows of
    an acceptor and month lie, after one shuffle of the detail, in arrays. The rows of acceptors with more than
    ``HOT_ROWS`` of them in a month, and the sets with all acceptors, have few slices a day for their
    rows: they are rolled up by users. ``detail`` is read several times and hence stored first.
    """
    detail = materialize(detail, "acceptor-detail", scratch).withColumn("_month", F.trunc("date", "MM"))
    acceptor, dims = ACCEPTOR_DIMS[0], ACCEPTOR_DIMS[1:]
    sets = acceptor_grouping_sets(True)
    user, sums = "o_custkey", {"net_volume_daily": "net"}
    by_month = ["_month", acceptor]
    rows, months = detail.agg(F.count(F.lit(1)), F.count_distinct("_month")).first()
    counting = -(-rows // COUNT_ROWS) or 1
    dealt = (counting, -(-COUNT_PARTS * counting // (months or 1)))

    def hot(rows: DataFrame, *keys: str) -> DataFrame:
        return F.broadcast(rows.groupBy(*keys).count().where(F.col("count") > HOT_ROWS).select(*keys))

    # few acceptors have so many rows at all, and months are only counted of them
    hot_months = materialize(hot(detail.join(hot(detail, acceptor), acceptor, "left_semi"), *by_month)
                             .toDF("_hot_month", "_hot"), "hot-acceptors", scratch)
    is_hot = F.col("_month").eqNullSafe(F.col("_hot_month")) & (F.col(acceptor) == F.col("_hot"))
    parts = [_day_cube(detail.withColumn(acceptor, F.lit(ALL)), ACCEPTOR_DIMS,
                       [s for s in sets if acceptor not in s], user, sums, *dealt)]
    rest = detail
    if not hot_months.isEmpty():
        rest = detail.join(F.broadcast(hot_months), is_hot, "left_anti")
        parts.append(_day_cube(detail.join(F.broadcast(hot_months), is_hot, "left_semi"), ACCEPTOR_DIMS,
                               [s for s in sets if acceptor in s], user, sums, *dealt))
    rolled = cube_rows(by_month, "date", dims, user, "net", [s[1:] for s in sets if acceptor in s], ALL)
    own = _spread(rest, -(-rows // TASK_ROWS) or 1, *by_month).select(acceptor, rolled.alias("_rows"))
    # not ``inline``, for which Spark filters by the array's size, even before the rows are dealt
    own = own.select(acceptor, F.inline_outer("_rows")).where("rows IS NOT NULL")
    out = own.select(
        "date", *ACCEPTOR_DIMS, F.col("users").alias("users_daily"), F.col("users_to_date").alias("users_mtd"),
        F.col("rows").alias("tx_daily"), F.col("rows_to_date").alias("tx_mtd"),
        F.col("value").cast(MONEY).alias("net_volume_daily"), F.col("value_to_date").cast(MONEY).alias("net_volume_mtd"))
    for part in parts:
        out = out.unionByName(part)
    return out


def acceptor_cube(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
                  supplier: DataFrame, since: dt.date | None = None,
                  full: bool = True, until: dt.date | None = None,
                  scratch: list[str] | None = None) -> DataFrame:
    """Card-acceptor cube: members acceptor (supplier), category (customer
    segment), abroad (nations differ), offline (status 'F'); 10000 = all.

    ``full=False`` builds only the grouping sets the forecast reads
    (acceptor and category rolled up), which is all the branch filters see. Paths of
    what ``full=True`` stores in the shared folder are appended to ``scratch``.
    """
    li = filter_since(lineitem, "l_shipdate", since, until).select(
        "l_orderkey", "l_suppkey", F.to_date("l_shipdate").alias("date"),
        "l_linestatus", "l_returnflag", money("l_extendedprice").alias("price"))
    # customers meet the orders, of which there are fewer than line items
    bought = orders.select("o_orderkey", "o_custkey").join(
        customer.select("c_custkey", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    detail = (li.join(bought, li.l_orderkey == F.col("o_orderkey"))
              .join(supplier.select("s_suppkey", "s_nationkey"),
                    F.col("l_suppkey") == F.col("s_suppkey"))
              .select("date",
                      F.col("s_suppkey").cast("int").alias("acceptor_id"),
                      _lookup(SEGMENT_CODES, "c_mktsegment").cast("int").alias("category_id"),
                      (F.col("c_nationkey") != F.col("s_nationkey")).cast("int").alias("is_abroad"),
                      (F.col("l_linestatus") == "F").cast("int").alias("is_offline"),
                      "o_custkey",
                      F.when(F.col("l_returnflag") == "R", -F.col("price"))
                      .otherwise(F.col("price")).alias("net")))
    if not full:
        return _flag_cube(detail.withColumn("_month", F.trunc("date", "MM")))
    return _acceptor_day_cube(detail, scratch)


# ------------------------------------------------------------ hourly_cube ----

def hourly_cube(events: DataFrame, since: dt.date | None = None, full: bool = True,
                until: dt.date | None = None) -> DataFrame:
    """Hourly bill / game / travel-card cubes in one frame (``feature`` column).

    Members: group (event type) and company (user_id % 10 + 1); 10000 = all.
    ``*_mtd`` run from the month start to the end of the hour.
    """
    ts = F.col("ts")
    hour = F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))
    detail = filter_since(events, "ts", since, until).select(
        _lookup(EVENT_FEATURE, "event_type").cast("int").alias("feature"),
        hour.alias("hour"),
        F.trunc(ts.cast("date"), "MM").alias("_month"),
        _lookup(EVENT_TYPE_CODES, "event_type").cast("int").alias("group_id"),
        (F.col("user_id") % 10 + 1).cast("int").alias("company_id"),
        "user_id")
    sets = [HOURLY_DIMS, ["group_id"], ["company_id"], []] if full else [[]]
    # one row per hour, members read and user: what a hot user is shuffled with
    read = [d for d in HOURLY_DIMS if any(d in s for s in sets)]
    detail = detail.groupBy("feature", "hour", "_month", *read, "user_id").agg(F.count(F.lit(1)).alias("_tx"))
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions")) if full else None
    cube = _cube_with_month_to_date(detail, "hour", HOURLY_DIMS, sets, "user_id", {},
                                    prefix=["feature"], within=["_month", "user_id"], tasks=tasks)
    return cube.withColumnsRenamed({"users_daily": "users_hourly", "tx_daily": "tx_hourly"})


# ---------------------------------------------------------------- inputs -----

@dataclass
class Inputs:
    """The metric facts one forecast run reads."""
    card_daily: DataFrame
    entry_type_daily: DataFrame
    fee_rows: DataFrame
    acceptor_cube: DataFrame
    hourly_cube: DataFrame


# Features of the three hourly cubes.
BILL, GAME, TRAVEL = 5, 6, 7


def hourly_sources(bill: DataFrame, game: DataFrame, travel: DataFrame,
                   members: tuple[str, str, str] = ("company_id", "sub_type_id", "company_id")) -> DataFrame:
    """The three hourly cubes as the one frame of ``Inputs``.

    Each has hour, group_id, its own member column (``members``), users_hourly,
    users_mtd, tx_hourly and tx_mtd.
    """
    parts = [cube.select(F.lit(feature).alias("feature"), "hour", "group_id", F.col(member).alias("company_id"),
                         "users_hourly", "users_mtd", "tx_hourly", "tx_mtd")
             for feature, cube, member in zip((BILL, GAME, TRAVEL), (bill, game, travel), members, strict=True)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# Files of a folder of facts, and the columns that a run reads of each.
FACT_COLUMNS = {
    "card_daily": "date date, online_volume decimal(20,2), offline_volume decimal(20,2), "
                  "online_count decimal(20,2), offline_count decimal(20,2)",
    "entry_type_daily": "date date, type_code int, volume decimal(20,2), volume_mtd decimal(20,2), "
                        "fee decimal(20,2), fee_mtd decimal(20,2)",
    "acceptor_cube": "date date, acceptor_id int, category_id int, is_abroad int, is_offline int, "
                     "users_daily long, users_mtd long, tx_daily long, tx_mtd long, "
                     "net_volume_daily decimal(20,2), net_volume_mtd decimal(20,2)",
    "bill_hourly": "hour timestamp_ntz, group_id int, company_id int, users_hourly long, users_mtd long, "
                   "tx_hourly long, tx_mtd long",
    "game_hourly": "hour timestamp_ntz, group_id int, sub_type_id int, users_hourly long, users_mtd long, "
                   "tx_hourly long, tx_mtd long",
    "travel_hourly": "hour timestamp_ntz, group_id int, company_id int, users_hourly long, users_mtd long, "
                     "tx_hourly long, tx_mtd long",
}


# The column that tells a fact row's time.
FACT_TIMES = {"card_daily": "date", "entry_type_daily": "date", "fee_rows": "created_at",
              "acceptor_cube": "date", "bill_hourly": "hour", "game_hourly": "hour", "travel_hourly": "hour"}


def read_facts(spark: SparkSession, folder: str) -> Inputs:
    """Inputs from a folder with one Parquet table per fact, read by the schemas above.

    ``fee_rows`` (created_at, fee) keeps the decimal type it is stored with.
    """
    def fact(name: str) -> DataFrame:
        return spark.read.schema(FACT_COLUMNS[name]).parquet(f"{folder}/{name}")

    return Inputs(card_daily=fact("card_daily"), entry_type_daily=fact("entry_type_daily"),
                  fee_rows=spark.read.parquet(f"{folder}/fee_rows").select("created_at", "fee"),
                  acceptor_cube=fact("acceptor_cube"),
                  hourly_cube=hourly_sources(fact("bill_hourly"), fact("game_hourly"), fact("travel_hourly")))


def write_facts(inputs: Inputs, folder: str, by_day: bool = False) -> None:
    """Store inputs as :func:`read_facts` reads them; ``by_day`` in one folder ``date=...`` a day."""
    def write(df: DataFrame, name: str) -> None:
        if by_day:
            time = FACT_TIMES[name]
            days = df if time == "date" else df.withColumn("date", F.col(time).cast("date"))
            days.hint("rebalance", "date").write.partitionBy("date").parquet(f"{folder}/{name}")
        else:
            df.write.parquet(f"{folder}/{name}")

    for name in ("card_daily", "entry_type_daily", "fee_rows", "acceptor_cube"):
        write(getattr(inputs, name), name)
    for feature, name, member in ((BILL, "bill_hourly", "company_id"), (GAME, "game_hourly", "sub_type_id"),
                                  (TRAVEL, "travel_hourly", "company_id")):
        write(inputs.hourly_cube.where(F.col("feature") == feature).drop("feature")
              .withColumnRenamed("company_id", member), name)


def standin_inputs(tables: TableSet, since: dt.date | None = None,
                   full_cubes: bool = False, until: dt.date | None = None,
                   scratch: list[str] | None = None) -> Inputs:
    """All stand-in inputs; cubes hold only the read slices unless ``full_cubes``.

    ``until`` (exclusive) drops later rows at the scan; figures of earlier
    days do not change (month-to-date sums only look back). Paths of what full cubes
    store in the shared folder are appended to ``scratch``.
    """
    return Inputs(
        card_daily=card_daily(tables.lineitem, since, until),
        entry_type_daily=entry_type_daily(tables.lineitem, since, until),
        fee_rows=fee_rows(tables.orders, since, until),
        acceptor_cube=acceptor_cube(tables.lineitem, tables.orders, tables.customer,
                                    tables.supplier, since, full=full_cubes, until=until, scratch=scratch),
        hourly_cube=hourly_cube(tables.events, since, full=full_cubes, until=until))
