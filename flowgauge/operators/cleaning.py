"""Cleaning rules: defaults, median fill, plausible ranges."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions import codes
from flowgauge.operators.quantiles import medians

RANGES = {"avg_speed_kmh": codes.SPEED_LIMITS, "vehicle_count": codes.VEHICLE_LIMITS}


def fill_defaults(df: DataFrame, defaults: Mapping) -> DataFrame:
    """NULLs of the named columns replaced by constants."""
    return df.withColumns(
        {n: F.coalesce(F.col(n), F.lit(v).cast(df.schema[n].dataType)) for n, v in defaults.items()}
    )


def fill_numbers(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    """NULLs and NaNs of numeric columns replaced; the columns become double."""
    out = {}
    for name, value in values.items():
        number = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
        out[name] = F.coalesce(number, F.lit(value).cast("double"))
    return df.withColumns(out)


def inside(ranges: Mapping[str, tuple]) -> Column:
    """True where every column lies in its closed range; NULL never does."""
    cond = F.lit(True)
    for name, (low, high) in ranges.items():
        cond = cond & F.coalesce(F.col(name).between(low, high), F.lit(False))
    return cond


def range_filter(df: DataFrame, ranges: Mapping[str, tuple] = RANGES) -> DataFrame:
    return df.filter(inside(ranges))


def outlier_counts(df: DataFrame, ranges: Mapping[str, tuple] = RANGES) -> DataFrame:
    """One row: rows before, rows kept, rows removed by ``range_filter``."""
    kept = F.count_if(inside(ranges))
    return df.agg(
        F.count(F.lit(1)).alias("n_before"),
        kept.alias("n_kept"),
        (F.count(F.lit(1)) - kept).alias("n_removed"),
    )


def fit_fill_values(readings: DataFrame, **options) -> dict[str, float | None]:
    """Medians of speed and vehicle count over all readings."""
    return medians(readings, ["avg_speed_kmh", "vehicle_count"], **options)


def fill_readings(readings: DataFrame, fill_values: Mapping[str, float | None]) -> DataFrame:
    filled = fill_numbers(readings, fill_values)
    return fill_defaults(filled, {"weather_condition": codes.DEFAULT_WEATHER})


def clean_readings(
    readings: DataFrame,
    fill_values: Mapping[str, float | None] | None = None,
    ranges: Mapping[str, tuple] = RANGES,
) -> DataFrame:
    """Fill missing values, drop implausible rows, settle the types.

    ``fill_values`` are fitted on ``readings`` unless given.
    """
    if fill_values is None:
        fill_values = fit_fill_values(readings)
    kept = range_filter(fill_readings(readings, fill_values), ranges)
    return kept.withColumns(
        {
            "is_holiday": F.col("is_holiday").cast("boolean"),
            "congestion_level": F.col("congestion_level").cast("int"),
        }
    )
