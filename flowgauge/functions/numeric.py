"""Numeric rules shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column, low, high) -> Column:
    """``value`` held within [low, high]; NULL stays NULL."""
    bounded = F.greatest(F.lit(low), F.least(F.lit(high), value))
    return F.when(value.isNotNull(), bounded)


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def mean_as_decimal(value: Column, precision: int, scale: int) -> Column:
    """Mean rounded half up to ``decimal(precision, scale)``."""
    return F.avg(value.cast("double")).cast(f"decimal({precision},{scale})")


def missing_or_zero(value: Column, default) -> Column:
    """``default`` where the value is NULL or 0."""
    return F.when(value.isNull() | (value == 0), F.lit(default)).otherwise(value)


def safe_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, 0 where the denominator is 0."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)
