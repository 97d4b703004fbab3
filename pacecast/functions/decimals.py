"""Decimal column helpers.

All arithmetic stays in Spark's exact decimal types (JVM side, codegen).
Spark's result-type rules (precision loss allowed, half-up rounding) decide
intermediate scales, so the helpers only fix the *input* types the way the
metric definitions state them; they never round on their own.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegralType, LongType

# Fixed types of the long daily series and of the forecast columns.
MONEY = DecimalType(20, 2)
SERIES_VALUE = DecimalType(21, 2)
SERIES_PTD = DecimalType(31, 2)


def dec(col: Column | str, precision: int, scale: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(DecimalType(precision, scale))


def money(col: Column | str) -> Column:
    """Cast to decimal(20,2); used on two-decimal inputs *before* summing."""
    return dec(col, 20, 2)


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def sum_or_zero(col: Column) -> Column:
    """Aggregate ``sum`` that yields 0 for an empty or all-NULL group."""
    return F.coalesce(F.sum(col), F.lit(0))


def total_type(kind: DataType) -> DataType:
    """The type of running totals of a column: ten digits more, as Spark's sum has.

    One digit below the widest type is left free, so that adding two totals
    keeps their scale. Types other than decimals stay as Spark sums them.
    """
    if not isinstance(kind, DecimalType):
        return LongType() if isinstance(kind, IntegralType) else kind
    return DecimalType(min(37, kind.precision + 10), kind.scale)
