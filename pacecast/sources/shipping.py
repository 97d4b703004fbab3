"""One pass over lineitem for the three facts that are built from it.

The card report, the entry-type fact and the cube slices of a forecast are all sums over line
items. Here every line item meets its dimensions once and is aggregated once, in two
grouping sets: the additive figures by (day, status, entry type, abroad), at most some
dozen rows a day, and the users as one mask of active days per (month, user) and cell. Both
shrink before their one common shuffle and end in a few rows per day, which are
written to the shared folder; the facts are read from there.

Line items without an order, customer or supplier count for the report and the entry types, not
for the cube, so the dimensions are joined from the left. Their keys are unique (FIXTURES.md).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decimals import MONEY, money
from ..session import materialize
from .standins import (CELLS, SLICES, Inputs, day_bit, entry_type_code, entry_types_to_date, fee_rows, filter_since,
                       flag_slices, hourly_cube, slice_masks, slice_users)
from .tables import TableSet

KEYS = ("date", "status", "type_code", "is_abroad")
FIGURES = ("price", "quantity", "net")


def _in_cell(abroad: int, offline: int) -> Column:
    return (F.col("is_abroad") == abroad) & ((F.col("status") == "F") == F.lit(offline == 1))


def line_items(tables: TableSet, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """Line items with what the three facts need of their order, customer and supplier."""
    orders = tables.orders.select("o_orderkey", "o_custkey")
    customer = tables.customer.select("c_custkey", F.col("c_nationkey").alias("_home"))
    supplier = tables.supplier.select("s_suppkey", F.col("s_nationkey").alias("_there"))
    price = money("l_extendedprice")
    # customers meet the orders, of which there are fewer than line items
    bought = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return (filter_since(tables.lineitem, "l_shipdate", since, until)
            .join(bought, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
            .select(F.to_date("l_shipdate").alias("date"), F.col("l_linestatus").alias("status"),
                    entry_type_code().alias("type_code"),
                    (F.col("_home") != F.col("_there")).cast("int").alias("is_abroad"),
                    F.col("c_custkey").alias("user"), price.alias("price"), money("l_quantity").alias("quantity"),
                    F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("net")))


def shipping_days(tables: TableSet, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """Rows of figures for each (date, status, type_code, is_abroad), and one row of user counts a day.

    ``is_figures`` tells them apart. Figures: ``n_rows``, ``price``, ``quantity``, ``net``; user
    counts: ``u<k>`` and ``n<k>`` of slice k. Line items without a ship day are figures of a null date.
    """
    items = line_items(tables, since, until).withColumn("_month", F.trunc("date", "MM"))
    users = ("_month", "user")
    sums = items.groupingSets([[F.col(c) for c in KEYS], [F.col(c) for c in users]], *KEYS, *users).agg(
        (F.grouping("user") == 1).alias("is_figures"), F.count(F.lit(1)).alias("n_rows"),
        *[F.sum(c).alias(c) for c in FIGURES],
        *[F.coalesce(F.bit_or(F.when(_in_cell(a, o), day_bit())), F.lit(0)).alias(f"_m{a}{o}") for a, o in CELLS])
    # rows of both kinds go on together, so that the aggregate is computed once: figures as
    # they are, a user's masks as a row for each active day
    anywhere = " | ".join(f"_m{a}{o}" for a, o in CELLS)
    days = F.explode(F.expr(f"CASE WHEN is_figures THEN array(-1) ELSE "
                            f"filter(sequence(0, 30), d -> shiftright({anywhere}, d) & 1 = 1) END")).alias("_day")
    rows = sums.select(*KEYS, "_month", "is_figures", "n_rows", *FIGURES, *slice_masks(), days)
    rows = rows.withColumn("date", F.when(F.col("is_figures"), F.col("date"))
                           .otherwise(F.date_add("_month", F.col("_day"))))
    return rows.groupBy("is_figures", *KEYS).agg(
        F.sum("n_rows").alias("n_rows"), *[F.sum(c).alias(c) for c in FIGURES], *slice_users())


def card_report(shipped: DataFrame) -> DataFrame:
    """``standins.card_daily`` of the figures."""
    online, offline = F.col("status") == "O", F.col("status") == "F"
    return shipped.where("is_figures").groupBy("date").agg(
        *[F.sum(F.when(side, F.col(c))).cast(MONEY).alias(f"{name}_{what}")
          for what, c in (("volume", "price"), ("count", "n_rows"))
          for name, side in (("online", online), ("offline", offline))])


def entry_types(shipped: DataFrame) -> DataFrame:
    """``standins.entry_type_daily`` of the figures."""
    return entry_types_to_date(shipped.where("is_figures").groupBy("date", "type_code").agg(
        F.sum("price").alias("volume"), F.sum("quantity").alias("fee")))


def cube_slices(shipped: DataFrame) -> DataFrame:
    """``standins.acceptor_cube`` with acceptor and category rolled up, of figures and user counts."""
    figures = shipped.where("is_figures").groupBy("date").agg(
        *[F.coalesce(F.sum(F.when(_in_cell(a, o), F.col("n_rows"))), F.lit(0)).alias(f"_tx{a}{o}") for a, o in CELLS],
        *[F.sum(F.when(_in_cell(a, o), F.col("net"))).alias(f"_net{a}{o}") for a, o in CELLS])
    users = shipped.where("NOT is_figures").select("date", *[f"{c}{k}" for k in range(len(SLICES)) for c in "un"])
    return flag_slices(figures.join(users, "date").withColumn("_month", F.trunc("date", "MM")))


def one_pass_inputs(tables: TableSet, since: dt.date | None = None, until: dt.date | None = None,
                    scratch: list[str] | None = None) -> Inputs:
    """The inputs of ``standins.standin_inputs`` (forecast slices only), with lineitem read once.

    The rows of :func:`shipping_days` and the hourly cube's slices are written here, so that several runs
    on the same inputs build them once; their paths are appended to ``scratch``.
    """
    shipped = materialize(shipping_days(tables, since, until), "shipping-days", scratch)
    return Inputs(card_daily=card_report(shipped), entry_type_daily=entry_types(shipped),
                  fee_rows=fee_rows(tables.orders, since, until), acceptor_cube=cube_slices(shipped),
                  hourly_cube=materialize(hourly_cube(tables.events, since, full=False, until=until),
                                          "hourly-slices", scratch))
