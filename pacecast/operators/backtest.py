"""O12 errors against the realised month end, O14 last month's accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forecast import _with, cast, ratio
from .series import KEYS


def backtest_errors(df: DataFrame) -> DataFrame:
    """Error of each expectation (NULL while the month is open) and its rate
    (0, not NULL, while open)."""
    cols = {}
    for k in (1, 2, 3):
        err = f"exp_m{k} - eop_realised"
        cols[f"err_m{k}"] = err
        cols[f"err_rate_m{k}"] = cast(ratio(cast(err, 38, 10), cast("eop_realised", 38, 10)), 20, 6)
    return _with(df, cols)


def lookback_accuracy(df: DataFrame, history: DataFrame | None,
                      prev_range: tuple | None = None) -> DataFrame:
    """``|1 - |error rate||`` of the row one month earlier (same series).

    ``history`` holds earlier output rows (the stored table, or the same
    computation for the previous month). ``prev_range = (lo, hi)`` cuts it
    to the days one month before the anchors with literal bounds on
    ``date`` (partition pruning on the stored table); it is then
    left-joined on (date one month back, series keys).
    Duplicate earlier rows fan out, as an unconstrained target would.
    """
    if history is None:
        return _with(df, {"acc_prev_m1": "CAST(NULL AS DECIMAL(20,6))",
                          "acc_prev_linear": "CAST(NULL AS DECIMAL(20,6))"})
    if prev_range is not None:
        history = history.filter((F.col("date") >= F.lit(prev_range[0]))
                                 & (F.col("date") <= F.lit(prev_range[1])))
    prev = history.select(
        F.col("date").alias("_prev_date"), *[F.col(k).alias(f"_prev_{k}") for k in KEYS],
        F.col("err_rate_m1").alias("_prev_err_rate"),
        F.col("linear_err_rate").alias("_prev_linear_rate"))
    cond = [F.add_months(df["date"], -1) == prev["_prev_date"]]
    cond += [df[k] == prev[f"_prev_{k}"] for k in KEYS]
    joined = df.join(prev, cond, "left")
    return _with(joined, {
        "acc_prev_m1": cast("ABS(1 - ABS(_prev_err_rate))", 20, 6),
        "acc_prev_linear": cast("ABS(1 - ABS(_prev_linear_rate))", 20, 6),
    }).drop("_prev_date", *[f"_prev_{k}" for k in KEYS], "_prev_err_rate", "_prev_linear_rate")
