"""The long daily metric series.

Every metric becomes rows of
``(date, feature, measure, period, entity, currency, value, value_ptd)``:
``value`` is the day's figure and ``value_ptd`` the month-to-date figure.
The forecast only ever reads the *largest* ``value`` and ``value_ptd`` of a
(series, date), so each builder reduces its input to one row per series and
day; that keeps everything after the daily aggregation small no matter how
many raw rows there are.

Each builder reads its source table **once**: branches that differ only by
a code or a member filter are one scan, one small broadcast mapping table
(its size is the length of a Python list) and one aggregation.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.decimals import (MONEY, SERIES_PTD, SERIES_VALUE, sum_or_zero, total_type,
                                  zero_if_null)
from ..sources.standins import ALL, Inputs

KEYS = ["feature", "measure", "period", "entity", "currency"]
SERIES_COLUMNS = ["date"] + KEYS + ["value", "value_ptd"]

# Measure codes: 0 unique users, 4 transaction count, 5 volume, 6 fee.
USERS, COUNT, VOLUME, FEE = 0, 4, 5, 6


_FINISH = (["CAST(date AS DATE) AS date"] + [f"CAST({k} AS INT) AS {k}" for k in KEYS]
           + [f"CAST(value AS {SERIES_VALUE.simpleString()}) AS value",
              f"CAST(value_ptd AS {SERIES_PTD.simpleString()}) AS value_ptd"])


def _finish(df: DataFrame) -> DataFrame:
    """Fixed column order and types of the long series."""
    return df.selectExpr(*_FINISH)


def _mapping(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A code/member mapping table; tiny by construction, so it is broadcast."""
    return F.broadcast(spark.createDataFrame(rows, schema))


# ---------------------------------------------------------------- O3 ---------

def month_to_date(df: DataFrame, keys: list[str], ts_col: str, value_col: str,
                  sum_col: str | None = None) -> DataFrame:
    """Per (keys, day): the largest row value and the month-to-date sum.

    The sum is that of ``sum_col`` (default: the value itself).

    The month-to-date figure is a running sum ordered by ``ts_col`` within
    (keys, year, month) where tied timestamps are peers; a day's figure is
    the largest running sum reached on that day. Rather than one window per
    month (one task holding a month of rows), it is a three-level scan:
    ties are first summed per timestamp (map-side partial aggregation), then
    running sums run inside one-second buckets, across a day's buckets, and
    across a month's days. Every window partition is bounded by the clock,
    not by the data: at most 10^6 distinct microsecond timestamps, 86,400
    seconds, or 31 days - so a hot month, day or minute cannot land in one
    task. For a date-grain ``ts_col`` the first two levels collapse.
    """
    return accumulated(daily_totals(df, keys, ts_col, value_col, sum_col), keys)


def daily_totals(df: DataFrame, keys: list[str], ts_col: str, value_col: str,
                 sum_col: str | None = None) -> DataFrame:
    """The part of :func:`month_to_date` that sees one day's rows at a time.

    Per (keys, day): ``value`` (largest row value), ``day_total`` and ``day_peak`` (the largest
    running sum within the day).
    """
    sum_col = sum_col or value_col
    kind = total_type(df.schema[sum_col].dataType)

    def total(col: Column) -> Column:
        return F.sum(col).cast(kind)

    v = zero_if_null(F.col(sum_col))
    is_date = dict(df.dtypes)[ts_col] == "date"
    day_keys = keys + ["date"]
    if is_date:
        per_day = (df.groupBy(*keys, F.col(ts_col).alias("date"))
                   .agg(total(v).alias("day_total"), F.max(F.col(value_col)).alias("value")))
        per_day = per_day.withColumn("day_peak", F.col("day_total"))
    else:
        ts = F.col(ts_col)
        per_ts = (df.groupBy(*keys, ts.alias("_ts"))
                  .agg(total(v).alias("_tot"), F.max(F.col(value_col)).alias("_max"))
                  .withColumn("date", F.col("_ts").cast("date"))
                  .withColumn("_bucket", F.hour("_ts") * 3600 + F.minute("_ts") * 60
                              + F.second("_ts")))
        in_bucket = (Window.partitionBy(*day_keys, "_bucket").orderBy("_ts")
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        per_bucket = (per_ts.withColumn("_run", F.sum("_tot").over(in_bucket).cast(kind))
                      .groupBy(*day_keys, "_bucket")
                      .agg(total("_tot").alias("_btot"), F.max("_run").alias("_bpeak"),
                           F.max("_max").alias("_bmax")))
        before_bucket = (Window.partitionBy(*day_keys).orderBy("_bucket")
                         .rowsBetween(Window.unboundedPreceding, -1))
        per_day = (per_bucket
                   .withColumn("_prev", zero_if_null(F.sum("_btot").over(before_bucket).cast(kind)))
                   .groupBy(*day_keys)
                   .agg(total("_btot").alias("day_total"),
                        F.max(F.col("_prev") + F.col("_bpeak")).cast(kind).alias("day_peak"),
                        F.max("_bmax").alias("value")))
    return per_day.select(*day_keys, "value", "day_total", "day_peak")


def accumulated(per_day: DataFrame, keys: list[str]) -> DataFrame:
    """``value_ptd`` of daily totals: the month's earlier days and the day's peak."""
    kind = per_day.schema["day_total"].dataType
    before_day = (Window.partitionBy(*keys, F.trunc("date", "MM")).orderBy("date")
                  .rowsBetween(Window.unboundedPreceding, -1))
    return per_day.select(
        *keys, "date", "value",
        (zero_if_null(F.sum("day_total").over(before_day).cast(kind)) + F.col("day_peak"))
        .alias("value_ptd"))


# ---------------------------------------------------------------- O4 ---------

@dataclass(frozen=True)
class PairTotal:
    """A metric that adds two columns of a daily report (NULL counts as 0)."""
    feature: int
    measure: int
    entity: int
    left: str
    right: str


def pair_total_series(df: DataFrame, pairs: list[PairTotal], since: dt.date | None = None,
                      date_col: str = "date") -> DataFrame:
    """Sum-of-two-columns metrics of a daily report, month-to-date by day."""
    src = df if since is None else df.filter(F.col(date_col) >= F.lit(since))
    return _finish(month_to_date(pair_rows(src, pairs, date_col), KEYS, "date", "v"))


def pair_rows(df: DataFrame, pairs: list[PairTotal], date_col: str = "date") -> DataFrame:
    """One row (date, keys, v) per report row and pair."""
    money_type = MONEY.simpleString()
    rows = ", ".join(
        f"{p.feature}, {p.measure}, 0, {p.entity}, 0, "
        f"CAST(COALESCE({p.left}, 0) AS {money_type}) + CAST(COALESCE({p.right}, 0) AS {money_type})"
        for p in pairs)
    return df.selectExpr(
        f"{date_col} AS date",
        f"stack({len(pairs)}, {rows}) AS (feature, measure, period, entity, currency, v)")


# ---------------------------------------------------------------- O5 ---------

@dataclass(frozen=True)
class CodedMetric:
    """A metric summed over rows whose type code is in ``codes``."""
    feature: int
    measure: int
    entity: int
    codes: tuple[int, ...]
    value_col: str
    ptd_col: str


_CODE_SCHEMA = StructType([StructField("_code", IntegerType()),
                           StructField("feature", IntegerType()),
                           StructField("measure", IntegerType()),
                           StructField("entity", IntegerType()),
                           StructField("which", StringType())])


def coded_series(spark: SparkSession, df: DataFrame, metrics: list[CodedMetric],
                 since: dt.date | None = None, code_col: str = "type_code") -> DataFrame:
    """Per-code metrics from a fact that already carries daily and MTD columns.

    One scan filtered to the used codes (pushed down), one broadcast join
    with the code map (a code may feed several metrics), one aggregation.
    """
    value_cols = sorted({(m.value_col, m.ptd_col) for m in metrics})
    rows = [(c, m.feature, m.measure, m.entity, f"{m.value_col}|{m.ptd_col}")
            for m in metrics for c in m.codes]
    codes = sorted({r[0] for r in rows})
    src = df.filter(F.col(code_col).isin(codes))
    if since is not None:
        src = src.filter(F.col("date") >= F.lit(since))
    joined = src.withColumnRenamed(code_col, "_code").join(
        _mapping(spark, rows, _CODE_SCHEMA), "_code")

    def pick(position: int) -> Column:
        expr = None
        for pair in value_cols:
            hit = F.col("which") == f"{pair[0]}|{pair[1]}"
            expr = (F.when(hit, F.col(pair[position])) if expr is None
                    else expr.when(hit, F.col(pair[position])))
        return expr

    daily = (joined.groupBy("date", "feature", "measure", "entity")
             .agg(sum_or_zero(pick(0)).cast(MONEY).alias("value"),
                  sum_or_zero(pick(1)).cast(MONEY).alias("value_ptd")))
    return _finish(daily.selectExpr("date", "feature", "measure", "0 AS period", "entity",
                                    "0 AS currency", "value", "value_ptd"))


# ---------------------------------------------------------------- O6 ---------

@dataclass(frozen=True)
class CubeSlice:
    """A cube slice: member values of the two flags (ALL = rolled up)."""
    feature: int
    is_abroad: int
    is_offline: int


# measure code -> (daily column, month-to-date column, take absolute value)
CUBE_MEASURES = {
    VOLUME: ("net_volume_daily", "net_volume_mtd", True),
    USERS: ("users_daily", "users_mtd", False),
    COUNT: ("tx_daily", "tx_mtd", False),
}

_SLICE_SCHEMA = StructType([StructField("is_abroad", IntegerType()),
                            StructField("is_offline", IntegerType()),
                            StructField("feature", IntegerType())])


def cube_slice_series(spark: SparkSession, cube: DataFrame, slices: list[CubeSlice],
                      measures: dict[int, tuple[str, str, bool]] = CUBE_MEASURES,
                      since: dt.date | None = None) -> DataFrame:
    """Slice metrics of the acceptor cube: acceptor and category rolled up,
    the two flags as listed; each slice gives one series per measure.

    One scan (member filters pushed down), one broadcast join with the
    slice map, one aggregation of all measures, then the measures are
    unpivoted with ``stack``.
    """
    src = cube.filter((F.col("acceptor_id") == ALL) & (F.col("category_id") == ALL))
    if since is not None:
        src = src.filter(F.col("date") >= F.lit(since))
    slice_map = _mapping(spark, [(s.is_abroad, s.is_offline, s.feature) for s in slices],
                         _SLICE_SCHEMA)
    joined = src.join(slice_map, ["is_abroad", "is_offline"])

    def measure_col(name: str, absolute: bool) -> Column:
        return F.abs(F.col(name)) if absolute else F.col(name)

    aggs = []
    for code, (day_col, mtd_col, absolute) in measures.items():
        aggs.append(sum_or_zero(measure_col(day_col, absolute)).cast(MONEY).alias(f"v{code}"))
        aggs.append(sum_or_zero(measure_col(mtd_col, absolute)).cast(MONEY).alias(f"p{code}"))
    daily = joined.groupBy("date", "feature").agg(*aggs)
    stack = ", ".join(f"{code}, v{code}, p{code}" for code in measures)
    long = daily.selectExpr("date", "feature", "0 AS period", "0 AS entity", "0 AS currency",
                            f"stack({len(measures)}, {stack}) as (measure, value, value_ptd)")
    return _finish(long)


# ---------------------------------------------------------------- O7 ---------

HOURLY_MEASURES = {USERS: ("users_hourly", "users_mtd"), COUNT: ("tx_hourly", "tx_mtd")}


def hourly_peak_series(cube: DataFrame, since: dt.date | None = None,
                       measures: dict[int, tuple[str, str]] = HOURLY_MEASURES) -> DataFrame:
    """Daily peak of hourly cubes (rows of all cubes, told apart by ``feature``).

    The day's value is the busiest hour, the day's month-to-date figure the
    largest hourly MTD figure; both NULL-propagating maxima.
    """
    src = cube.filter((F.col("group_id") == ALL) & (F.col("company_id") == ALL))
    if since is not None:
        src = src.filter(F.col("hour") >= F.lit(since).cast("timestamp_ntz"))
    aggs = []
    for code, (hour_col, mtd_col) in measures.items():
        aggs.append(F.max(hour_col).cast(MONEY).alias(f"v{code}"))
        aggs.append(F.max(mtd_col).cast(MONEY).alias(f"p{code}"))
    daily = src.groupBy(F.col("hour").cast("date").alias("date"), "feature").agg(*aggs)
    stack = ", ".join(f"{code}, v{code}, p{code}" for code in measures)
    long = daily.selectExpr("date", "feature", "0 AS period", "0 AS entity", "0 AS currency",
                            f"stack({len(measures)}, {stack}) as (measure, value, value_ptd)")
    return _finish(long)


# ------------------------------------------------------------- fee (B5) ------

def row_fee_series(fee_rows: DataFrame, feature: int, measure: int, entity: int,
                   since: dt.date | None = None, ts_col: str = "created_at",
                   value_col: str = "fee") -> DataFrame:
    """Row-grain fee report: value = a row's fee in two decimals, PTD = running sum by
    timestamp of the fees as they are, in two decimals at the end."""
    src = fee_rows
    if since is not None:
        src = src.filter(F.col(ts_col) >= F.lit(since).cast("timestamp_ntz"))
    daily = month_to_date(fee_source(src, feature, measure, entity, ts_col, value_col), KEYS, ts_col, "v", "fee")
    return _finish(daily.withColumn("value_ptd", F.col("value_ptd").cast(MONEY)))


def fee_source(df: DataFrame, feature: int, measure: int, entity: int, ts_col: str = "created_at",
               value_col: str = "fee") -> DataFrame:
    """Fee rows with their keys: ``fee`` as it is, ``v`` in two decimals."""
    return df.selectExpr(ts_col, f"COALESCE({value_col}, 0) AS fee",
                         f"CAST(COALESCE({value_col}, 0) AS {MONEY.simpleString()}) AS v",
                         f"{feature} AS feature", f"{measure} AS measure", "0 AS period",
                         f"{entity} AS entity", "0 AS currency")


# ---------------------------------------------------------------- O8 ---------

# Metric codes of the reference's 37 branches.
# feature/measure/entity of the two card-report sums:
CARD_PAIRS = [
    PairTotal(0, VOLUME, 2, "online_volume", "offline_volume"),
    PairTotal(0, COUNT, 2, "online_count", "offline_count"),
]
# total fee from the row-grain fee report: feature 3, measure 6, entity 2
FEE_METRIC = (3, FEE, 2)
# entry-type codes -> metrics (value column, month-to-date column):
CODED_METRICS = [
    CodedMetric(1, VOLUME, 0, (71, 73), "volume", "volume_mtd"),
    CodedMetric(2, VOLUME, 0, (64,), "volume", "volume_mtd"),
    CodedMetric(4, VOLUME, 0, (29,), "volume", "volume_mtd"),
    CodedMetric(5, VOLUME, 0, (28,), "volume", "volume_mtd"),
    CodedMetric(6, VOLUME, 0, (30,), "volume", "volume_mtd"),
    CodedMetric(7, VOLUME, 0, (31,), "volume", "volume_mtd"),
    CodedMetric(8, VOLUME, 0, (91,), "volume", "volume_mtd"),
    CodedMetric(15, VOLUME, 0, (14,), "volume", "volume_mtd"),
    CodedMetric(16, VOLUME, 0, (15,), "volume", "volume_mtd"),
    CodedMetric(15, FEE, 0, (14,), "fee", "fee_mtd"),
]
# acceptor-cube slices (abroad, offline; 10000 = all) -> feature:
CUBE_SLICES = [
    CubeSlice(9, ALL, 1),
    CubeSlice(10, ALL, 0),
    CubeSlice(11, 0, ALL),
    CubeSlice(12, 1, ALL),
    CubeSlice(13, 1, 0),
    CubeSlice(14, 1, 1),
]


def metric_series(spark: SparkSession, inputs: Inputs, since: dt.date | None = None,
                  as_of: dt.date | None = None) -> DataFrame:
    """All 37 metrics as one long daily series (one scan per input table).

    By default there is no upper date bound: rows after the anchors count
    (they keep a series alive and fill month ends). ``as_of`` keeps only
    days before it.
    """
    parts = [
        pair_total_series(inputs.card_daily, CARD_PAIRS, since),
        coded_series(spark, inputs.entry_type_daily, CODED_METRICS, since),
        row_fee_series(inputs.fee_rows, *FEE_METRIC, since=since),
        cube_slice_series(spark, inputs.acceptor_cube, CUBE_SLICES, since=since),
        hourly_peak_series(inputs.hourly_cube, since),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out if as_of is None else out.filter(F.col("date") < F.lit(as_of))
