"""The 37 daily series as a stored table that follows its facts day by day.

``SeriesStore.sync`` compares a fingerprint of every fact and day with the one kept beside the rows
and recomputes only the days that differ: their rows are read from the facts (by partition
where facts are stored by day, else by a pushed-down time filter), reduced to one row per series,
and put in the place of the old ones, together with the new fingerprints, in one commit. Rows of a day
hold what the day alone decides: the value and either the fact's own month-to-date figure or
the day's total and peak. Month-to-date sums are made of the totals when the series is read, so a
late row changes one stored day and moves every later day of its month.

Fingerprints: for a fact stored in ``date=...`` folders, the names, sizes and times of a day's files
(no data is read); for any other fact, count, sum and exclusive-or of its rows' hashes by day.
The store has a part per month (a few hundred rows), its state one fingerprint per fact and
day; both are bounded by the calendar, whatever the facts' size.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start, py_month_start
from ..functions.decimals import MONEY, SERIES_PTD, SERIES_VALUE
from ..operators.series import (CARD_PAIRS, CODED_METRICS, CUBE_SLICES, FEE_METRIC, KEYS, _finish,
                                accumulated, coded_series, cube_slice_series, daily_totals, fee_source,
                                hourly_peak_series, pair_rows)
from ..sources.commits import CommittedTable
from ..sources.standins import BILL, FACT_COLUMNS, FACT_TIMES, GAME, TRAVEL

#: Totals of any fact: up to ten decimals are kept exactly.
TOTAL = "decimal(38,10)"
#: From so many day ranges on, a condition lists days instead of ranges.
MANY_RANGES = 32
HOURLY = {"bill_hourly": (BILL, "company_id"), "game_hourly": (GAME, "sub_type_id"),
          "travel_hourly": (TRAVEL, "company_id")}


def day_ranges(days: list[dt.date]) -> list[tuple[dt.date, dt.date]]:
    """Sorted days as ranges ``[a, b)`` of neighbours."""
    out: list[tuple[dt.date, dt.date]] = []
    for day in sorted(days):
        if out and out[-1][1] == day:
            out[-1] = (out[-1][0], day + dt.timedelta(days=1))
        else:
            out.append((day, day + dt.timedelta(days=1)))
    return out


def _within(col: str, kind: str, ranges: list[tuple[dt.date, dt.date]]) -> Column:
    """Whether a date or timestamp lies in one of the sorted day ranges; literal bounds reach the scan.

    Many ranges (a sparse fact has gaps everywhere) are the bounds of all and one flat list of days, since a
    condition per range would nest too deep.
    """
    def between(a: dt.date, b: dt.date) -> Column:
        return (F.col(col) >= F.lit(a).cast(kind)) & (F.col(col) < F.lit(b).cast(kind))

    if len(ranges) > MANY_RANGES:
        days = [a + dt.timedelta(days=k) for a, b in ranges for k in range((b - a).days)]
        return between(ranges[0][0], ranges[-1][1]) & F.col(col).cast("date").isin(days)
    found = F.lit(False)
    for a, b in ranges:
        found = found | between(a, b)
    return found


class FactFolder:
    """Facts stored as one Parquet table each (``standins.read_facts``), some or all in ``date=...`` folders."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def by_day(self, name: str) -> bool:
        """Whether a fact lies in ``date=...`` folders."""
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return any(s.getPath().getName().startswith("date=") for s in fs.listStatus(at))

    def read(self, name: str, ranges: list[tuple[dt.date, dt.date]] | None = None) -> DataFrame:
        """A fact, or its rows of some days only."""
        time, path = FACT_TIMES[name], f"{self.folder}/{name}"
        by_day = self.by_day(name)
        if name in FACT_COLUMNS:
            extra = ", date date" if by_day and time != "date" else ""
            rows = self.spark.read.schema(FACT_COLUMNS[name] + extra).parquet(path)
        else:  # fees keep the decimal type they are stored with
            rows = self.spark.read.parquet(path).select(time, "fee", *(["date"] if by_day else []))
        if ranges is not None:
            kind = "date" if by_day or time == "date" else rows.schema[time].dataType.simpleString()
            rows = rows.where(_within("date" if by_day else time, kind, ranges))
        return rows.drop("date") if by_day and time != "date" else rows

    def fingerprints(self, since: dt.date | None = None) -> dict[str, dict[str, str]]:
        """By fact and day (ISO): a digest that changes with the day's rows."""
        out: dict[str, dict[str, str]] = {}
        for name, time in FACT_TIMES.items():
            if self.by_day(name):
                # the files' listing alone: a reader of whole files that is not asked for their content
                rows = self.spark.read.format("binaryFile").load(f"{self.folder}/{name}")
                day, value = F.col("date").cast("date"), F.xxhash64("path", "length", "modificationTime")
            else:
                rows = self.read(name)
                # which columns are null is part of the hash
                value = F.xxhash64(*rows.columns, *[F.col(c).isNull() for c in rows.columns])
                if since is not None:
                    rows = rows.where(F.col(time) >= F.lit(since).cast(rows.schema[time].dataType))
                day = F.col(time).cast("date")
            days = rows.groupBy(day.alias("day")).agg(
                F.count("*").alias("n"), F.sum(value.cast("decimal(38,0)")).alias("s"), F.bit_xor(value).alias("x"))
            # one row a day
            marks = {r["day"].isoformat(): (r["n"], r["s"], r["x"]) for r in days.collect() if r["day"]}
            out[name] = {day: hashlib.sha256(repr(mark).encode()).hexdigest()[:16] for day, mark in marks.items()
                         if since is None or day >= since.isoformat()}
        return out


def _daily(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """A fact's rows as the store keeps them: date, keys, value, value_ptd or day_total and day_peak."""
    if name in ("card_daily", "fee_rows"):
        if name == "card_daily":
            daily = daily_totals(pair_rows(rows, CARD_PAIRS), KEYS, "date", "v")
        else:
            if rows.schema["fee"].dataType.scale > 10:
                raise ValueError("fees of more than ten decimals")
            daily = daily_totals(fee_source(rows, *FEE_METRIC), KEYS, FACT_TIMES[name], "v", "fee")
        return daily.select(
            "date", *[F.col(k).cast("int").alias(k) for k in KEYS], F.col("value").cast(SERIES_VALUE).alias("value"),
            F.lit(None).cast(SERIES_PTD).alias("value_ptd"),
            *[F.col(c).cast(TOTAL).alias(c) for c in ("day_total", "day_peak")])
    if name == "entry_type_daily":
        series = coded_series(spark, rows, CODED_METRICS)
    elif name == "acceptor_cube":
        series = cube_slice_series(spark, rows, CUBE_SLICES)
    else:
        feature, member = HOURLY[name]
        series = hourly_peak_series(rows.withColumn("feature", F.lit(feature)).withColumnRenamed(member, "company_id"))
    none = F.lit(None).cast(TOTAL)
    return series.withColumns({"day_total": none, "day_peak": none})


class SeriesStore:
    """Daily series at ``path``, kept up to date with a folder of facts; a source for ``run_day``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = CommittedTable(spark, path, part="month")

    def sync(self, facts: FactFolder, since: dt.date | None = None) -> dict[str, list[dt.date]]:
        """Recompute the days from ``since`` on whose facts changed; these days by fact.

        A day whose rows are gone counts as changed. Without ``since`` all days are compared.
        """
        now, then = facts.fingerprints(since), self.table.state()
        changed: dict[str, list[dt.date]] = {}
        for name, marks in now.items():
            old = {d: m for d, m in then.get(name, {}).items() if since is None or d >= since.isoformat()}
            days = sorted(d for d in marks.keys() | old.keys() if marks.get(d) != old.get(d))
            if days:
                changed[name] = [dt.date.fromisoformat(d) for d in days]
        if not changed:
            return {}
        months = {py_month_start(d) for days in changed.values() for d in days}
        rows = self._kept(changed, months)
        for name, days in changed.items():
            found = _daily(self.spark, name, facts.read(name, day_ranges(days))).withColumn("fact", F.lit(name))
            found = found.withColumn("month", month_start(F.col("date")))
            rows = found if rows is None else rows.unionByName(found)

        def state(old: dict) -> dict:
            merged = defaultdict(dict, {name: dict(marks) for name, marks in old.items()})
            for name, days in changed.items():
                for day in map(dt.date.isoformat, days):
                    merged[name].pop(day, None)
                    if day in now[name]:
                        merged[name][day] = now[name][day]
            return dict(merged)

        self.table.replace(rows, months.__contains__, state)
        return changed

    def _kept(self, changed: dict[str, list[dt.date]], months: set[dt.date]) -> DataFrame | None:
        """Stored rows of the touched months that stay as they are."""
        stored = self.table.read(min(months), max(months) + dt.timedelta(days=1))
        if stored is None:
            return None
        gone = F.lit(False)
        for name, days in changed.items():
            gone = gone | ((F.col("fact") == name) & _within("date", "date", day_ranges(days)))
        return stored.where(F.col("month").isin(sorted(months)) & ~gone)

    def series(self, since: dt.date | None = None, as_of: dt.date | None = None) -> DataFrame:
        """The long daily series, as ``metric_series`` gives it; ``since`` is a month start."""
        stored = self.table.read(since, None if as_of is None else as_of)
        if stored is None:
            raise ValueError(f"nothing stored at {self.table.path}: sync first")
        direct = _finish(stored.where("day_total is null"))
        sums = accumulated(stored.where("day_total is not null").drop("value_ptd"), ["fact", *KEYS])
        # fees are rounded to two decimals at the end, after the sum
        ptd = F.when(F.col("fact") == "fee_rows", F.col("value_ptd").cast(MONEY).cast(SERIES_PTD))
        out = direct.unionByName(_finish(sums.withColumn("value_ptd", ptd.otherwise(
            F.col("value_ptd").cast(SERIES_PTD)))))
        return out if as_of is None else out.filter(F.col("date") < F.lit(as_of))
