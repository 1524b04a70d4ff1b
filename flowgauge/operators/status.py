"""Current status per key and the reports on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions import codes
from flowgauge.functions.calendar import hours_before

STATUS_COLUMNS = (
    "avg_speed_kmh", "vehicle_count", "congestion_level", "weather_condition", "recorded_at",
)


def optional_equals(df: DataFrame, name: str, value) -> DataFrame:
    """Rows with ``name = value``; every row when ``value`` is None."""
    return df if value is None else df.filter(F.col(name) == F.lit(value))


def check_range(name: str, value: int, low: int, high: int) -> int:
    if not low <= value <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {value}")
    return value


def latest_per_key(
    readings: DataFrame,
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
    columns: Sequence[str] = STATUS_COLUMNS,
    as_of=None,
) -> DataFrame:
    """The newest reading of each key; equal times are decided by ``tie``.

    ``max_by`` is combined before the shuffle, so each task sends one row per
    key however many rows the key holds.
    """
    if as_of is not None:
        readings = readings.filter(F.col(ts) <= F.lit(as_of))
    newest = F.max_by(F.struct(*columns), F.struct(ts, tie))
    return readings.groupBy(key).agg(newest.alias("_newest")).select(key, "_newest.*")


def current_status(
    segments: DataFrame,
    readings: DataFrame,
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
    columns: Sequence[str] = STATUS_COLUMNS,
    as_of=None,
    level: str = "congestion_level",
) -> DataFrame:
    """Every segment with its newest reading, label and colour.

    Segments without readings stay, with NULLs.
    """
    newest = latest_per_key(readings, key, ts, tie, columns, as_of)
    status = segments.join(newest, key, "left")
    return status.withColumns(
        {
            "status_label": codes.level_label(F.col(level)),
            "status_color": codes.level_color(F.col(level)),
        }
    )


def realtime(status: DataFrame, district=None, key: str = "segment_id") -> DataFrame:
    """Status rows, worst level first; segments without data lead."""
    rows = optional_equals(status, "district_code", district)
    return rows.orderBy(
        F.col("congestion_level").desc_nulls_first(),
        F.col("district_code").asc_nulls_last(),
        F.col(key).asc(),
    )


def level_summary(status: DataFrame, level: str = "congestion_level") -> DataFrame:
    """One row: segments per level, total, and how many have no data.

    A segment without data counts as level 0.
    """
    shown = F.coalesce(F.col(level), F.lit(0))
    return status.agg(
        *[F.count_if(shown == k).alias(name) for k, name in codes.SUMMARY_NAMES.items()],
        F.count(F.lit(1)).alias("total_segments"),
        F.count_if(F.col(level).isNull()).alias("n_no_data"),
    )


def hotspots(
    status: DataFrame,
    limit: int = 10,
    *,
    observed_only: bool = False,
    key: str = "segment_id",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The ``limit`` (1-50) worst segments: level down, then speed up, with rank.

    Segments without data come first unless ``observed_only``.
    """
    check_range("limit", limit, 1, 50)
    order = [
        F.col("congestion_level").desc_nulls_first(),
        F.col("avg_speed_kmh").asc_nulls_last(),
        F.col(key).asc(),
    ]
    if observed_only:
        status = status.filter(F.col("congestion_level").isNotNull())
    if columns:
        status = status.select(*columns)
    top = status.orderBy(*order).limit(limit)
    # at most 50 rows are left here, so one task may number them
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def history(
    readings: DataFrame,
    key_value,
    hours: int = 24,
    *,
    as_of=None,
    until_as_of: bool = False,
    limit: int | None = None,
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
    date_column: str | None = None,
) -> DataFrame:
    """Readings of one key in the last ``hours`` (1-168), newest first.

    There is no upper time bound unless ``until_as_of``. ``date_column`` is
    the partition column of the stored table, used to skip older folders.
    """
    check_range("hours", hours, 1, 168)
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    since = hours_before(now, hours)
    rows = readings.filter((F.col(key) == F.lit(key_value)) & (F.col(ts) >= since))
    if until_as_of:
        rows = rows.filter(F.col(ts) <= now)
    if date_column:
        rows = rows.filter(F.col(date_column) >= since.cast("date"))
    newest = rows.orderBy(F.col(ts).desc(), F.col(tie).desc())
    newest = newest if limit is None else newest.limit(limit)
    return newest.select(
        ts, "hour", "avg_speed_kmh", "vehicle_count", "congestion_level", "weather_condition"
    )


def segments_with_district(segments: DataFrame, districts: DataFrame, district=None) -> DataFrame:
    """Segments with the name of their district; those without one drop out."""
    names = districts.select(F.col("code").alias("district_code"), F.col("name").alias("district_name"))
    rows = optional_equals(segments, "district_code", district).join(names, "district_code")
    return rows.select(*segments.columns, "district_name").orderBy(
        "district_code", "street_name", "segment_id"
    )


def find_by_key(df: DataFrame, key: str, value) -> DataFrame:
    """The row of one key, or no row."""
    return df.filter(F.col(key) == F.lit(value)).limit(1)


def located(
    df: DataFrame, columns: Sequence[str], *, zero_is_missing: bool = False
) -> DataFrame:
    """Rows that have all the given coordinates."""
    cond: Column = F.lit(True)
    for name in columns:
        cond = cond & F.col(name).isNotNull()
        if zero_is_missing:
            cond = cond & (F.col(name) != 0)
    return df.filter(cond)
