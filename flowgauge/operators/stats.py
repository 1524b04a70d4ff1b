"""Period statistics, distributions and pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions import codes
from flowgauge.functions.numeric import mean_as_decimal
from flowgauge.operators.status import check_range, optional_equals


def hourly_stats(
    readings: DataFrame,
    day_of_week: int | None = None,
    level_type: tuple[int, int] = (3, 2),
    speed_type: tuple[int, int] = (5, 2),
) -> DataFrame:
    """Mean level, mean speed and row count for each hour of each weekday.

    The types are the decimals the means are rounded to; a wider table needs
    a wider type.
    """
    if day_of_week is not None:
        check_range("day_of_week", day_of_week, 0, 6)
    rows = optional_equals(readings, "day_of_week", day_of_week)
    return rows.groupBy("hour", "day_of_week").agg(
        mean_as_decimal(F.col("congestion_level"), *level_type).alias("avg_congestion"),
        mean_as_decimal(F.col("avg_speed_kmh"), *speed_type).alias("avg_speed"),
        F.count(F.lit(1)).alias("record_count"),
    )


def heatmap(stats: DataFrame, value: str = "avg_congestion") -> DataFrame:
    """Weekday rows by hour columns ``h00`` ... ``h23``."""
    hours = list(range(24))
    wide = stats.groupBy("day_of_week").pivot("hour", hours).agg(F.avg(value))
    return wide.select("day_of_week", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])


def class_distribution(
    df: DataFrame, label: str = "congestion_level", split: str = "set"
) -> DataFrame:
    """Rows, share and percent of every class within each set, with its label."""
    counts = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(split))
    return counts.withColumn("share", share).select(
        split,
        label,
        codes.level_label(F.col(label)).alias("label_text"),
        "n",
        "share",
        (F.col("share") * 100).alias("percent"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
