"""Calendar parts and flags of a reading."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIODS = {"hour": ("hour", 24), "dow": ("day_of_week", 7), "month": ("month", 12)}


def date_parts(ts: Column) -> dict[str, Column]:
    """Hour, weekday (0 = Monday) and month of a timestamp."""
    return {"hour": F.hour(ts), "day_of_week": F.weekday(ts), "month": F.month(ts)}


def is_weekend(day_of_week: Column) -> Column:
    return (day_of_week >= 5).cast("int")


def is_rush_hour(hour: Column) -> Column:
    return (hour.between(6, 8) | hour.between(16, 19)).cast("int")


def cyclic(value: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of the position within a period."""
    angle = value.cast("double") * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def cyclic_columns() -> dict[str, Column]:
    """``hour_sin`` ... ``month_cos`` for the standard calendar columns."""
    out = {}
    for name, (source, period) in PERIODS.items():
        out[f"{name}_sin"], out[f"{name}_cos"] = cyclic(F.col(source), period)
    return out


def hours_before(as_of: Column, hours: int) -> Column:
    return as_of - F.make_dt_interval(hours=F.lit(hours))
