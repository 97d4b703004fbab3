"""O10 pace forecast, O11 dispersion bands, O13 straight-line projection.

All columns are row-local decimal expressions over the lookup frame, kept
inside whole-stage codegen. They are written as Spark SQL expression text
(one ``expr`` per output column instead of thousands of Column objects
built through the Python bridge); ``1.0`` is the decimal(2,1) literal.
Input types are fixed by explicit casts exactly where the metric
definition places them; Spark's decimal rules (precision loss allowed,
half-up) set every intermediate scale - e.g. the rate inside the month-k
expectations carries 6 decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cast(x: str, precision: int, scale: int) -> str:
    return f"CAST({x} AS DECIMAL({precision},{scale}))"


def ratio(numerator: str, denominator: str) -> str:
    """``coalesce(n * 1.0 / nullif(d, 0), 0)``: 0 for a missing or zero base."""
    return f"COALESCE(({numerator}) * 1.0 / NULLIF({denominator}, 0), 0)"


def adjusted_end(ptd: str, value: str, excess: str, precision: int | None = None,
                 scale: int | None = None) -> str:
    """Month-k end aligned to this month's length.

    PTD at the aligned end plus, when this month is longer, the missing
    days priced at month k's last-day value. NULL if either is missing.
    """
    if precision is not None:
        ptd, value = cast(ptd, precision, scale), cast(value, precision, scale)
    return f"({ptd} + CASE WHEN {excess} > 0 THEN {excess} * {value} ELSE 0 END)"


def _wide(name: str) -> str:
    return cast(name, 38, 10)


def forecast_expressions() -> dict[str, str]:
    """Rates of earlier months, the three month-end expectations and their mean."""
    adj = {k: adjusted_end(f"P_m{k}", f"V_e{k}", f"x{k}") for k in (1, 2, 3)}
    adj_wide = {k: adjusted_end(f"P_m{k}", f"V_e{k}", f"x{k}", 38, 10) for k in (1, 2, 3)}
    # share of month k done on the same day (6 decimals by Spark's rules)
    done = {k: ratio(_wide(f"P_p{k}"), adj_wide[k]) for k in (1, 2, 3)}
    ptd = _wide("P_anchor")
    raw = {
        1: ratio(ptd, done[1]),
        2: ratio(ptd, done[2]),
        3: ratio(f"{ptd} * {adj_wide[3]}", _wide("P_p3")),  # multiply first
    }
    return {
        "ptd": "P_anchor",
        "ptd_m1": "P_p1",
        "ptd_m2": "P_p2",
        "ptd_m3": "P_p3",
        "eop_adj_m1": adj[1],
        "eop_adj_m2": adj[2],
        "eop_adj_m3": adj[3],
        "rate_m1": ratio(cast("P_p1", 20, 6), adjusted_end("P_m1", "V_e1", "x1", 20, 6)),
        "rate_m2": cast(done[2], 20, 6),
        "rate_m3": cast(done[3], 20, 6),
        "exp_m1": cast(raw[1], 20, 2),
        "exp_m2": cast(raw[2], 20, 2),
        "exp_m3": cast(raw[3], 20, 2),
        "exp_mean": cast(f"({raw[1]} + {raw[2]} + {raw[3]}) / 3", 20, 2),
        "eop_realised": "P_e0",
        "eop_m1": "P_e1",
        "eop_m2": "P_e2",
        "eop_m3": "P_e3",
    }


def _with(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in exprs.items()})


def pace_forecast(lookups: DataFrame) -> DataFrame:
    return _with(lookups, forecast_expressions())


def dispersion_bands(df: DataFrame) -> DataFrame:
    """Population spread of the three expectations around their mean, and
    each expectation (and the mean) plus/minus one spread (doubles)."""
    dev = [f"CAST(exp_m{k} - exp_mean AS DOUBLE)" for k in (1, 2, 3)]
    std = f"SQRT(({dev[0]} * {dev[0]} + {dev[1]} * {dev[1]} + {dev[2]} * {dev[2]}) / 3)"
    out = _with(df, {"exp_std": std})
    bands = {}
    for name in ("exp_m1", "exp_m2", "exp_m3", "exp_mean"):
        bands[f"{name}_lo"] = f"CAST({name} AS DOUBLE) - exp_std"
        bands[f"{name}_hi"] = f"CAST({name} AS DOUBLE) + exp_std"
    return _with(out, bands)


def linear_projection(df: DataFrame) -> DataFrame:
    """Straight-line month end: PTD scaled by days in month / day of month,
    its error against the realised end and the error rate (0 while open)."""
    line = f"days_in_month * {cast('ptd', 20, 6)} / DAY(date)"
    realised = cast("eop_realised", 20, 6)
    miss = f"{line} - {realised}"
    return _with(df, {
        "linear_exp": cast(line, 20, 2),
        "linear_err": cast(miss, 20, 2),
        "linear_err_rate": ratio(miss, realised),
    })
