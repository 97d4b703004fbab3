"""Calendar column expressions (month starts/ends, clamped look-backs).

Spark's ``add_months`` clamps to the end of a shorter month and does not
stick to month ends (03-31 -> 02-29, 02-29 -> 01-29), which is the
look-back rule the forecast needs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def month_end(col: Column) -> Column:
    return F.last_day(col)


def months_back(col: Column, k: int) -> Column:
    return F.add_months(col, -k)


def as_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def py_month_start(day: dt.date) -> dt.date:
    return day.replace(day=1)


def py_add_months(day: dt.date, k: int) -> dt.date:
    """Driver-side twin of ``add_months`` for run parameters (scalars only)."""
    month_index = day.year * 12 + (day.month - 1) + k
    year, month = divmod(month_index, 12)
    month += 1
    last = (dt.date(year + (month == 12), month % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(year, month, min(day.day, last))


def run_window(base_day: str | dt.date) -> tuple[dt.date, dt.date]:
    """Anchor range ``[lo, hi)`` recomputed by a run on ``base_day``.

    On the 1st the whole previous month is redone (realised values are
    known now); on any other day only yesterday.
    """
    base = as_date(base_day)
    yesterday = base - dt.timedelta(days=1)
    lo = py_month_start(yesterday) if base.day == 1 else yesterday
    return lo, base
