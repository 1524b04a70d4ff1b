"""Hot groups: sliced results equal the plain window's."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowgauge.operators import slices
from flowgauge.plans import adapters as src


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on one key, many of them at one time."""
    rows = src.readings(spark, "/root/testdata/sf0.001")
    rows = rows.withColumn(
        "segment_id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("segment_id"))
    )
    burst = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    rows = rows.withColumn(
        "recorded_at",
        F.when(F.col("id") % 9 == 0, burst).otherwise(F.col("recorded_at")),
    )
    return rows.select("id", "segment_id", "recorded_at", "avg_speed_kmh").cache()


ORDER = ["recorded_at", "id"]


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_no_slice_is_too_full_and_all_rows_stay(skewed):
    sliced = slices.slice_hot_groups(skewed, ["segment_id"], ORDER, 20)
    assert sliced.hot
    sizes = sliced.rows.groupBy(*sliced.partition).count()
    assert sizes.agg(F.max("count")).first()[0] <= 20
    assert sliced.rows.count() == skewed.count()


def test_slices_follow_the_order(skewed):
    sliced = slices.slice_hot_groups(skewed, ["segment_id"], ORDER, 20)
    w = Window.partitionBy("segment_id")
    by_slice = F.row_number().over(w.orderBy(slices._SLICE, *ORDER))
    by_time = F.row_number().over(w.orderBy(*ORDER))
    assert sliced.rows.withColumn("a", by_slice).withColumn("b", by_time).filter("a != b").isEmpty()


def test_known_bound_skips_the_slices(skewed):
    assert not slices.slice_hot_groups(skewed, ["segment_id"], ORDER, 20, largest=20).hot


@pytest.mark.parametrize("limit", [5, 40, 10_000])
def test_row_positions(skewed, limit):
    plain = skewed.withColumn(
        "p", F.row_number().over(Window.partitionBy("segment_id").orderBy(*ORDER)).cast("bigint") - 1
    )
    assert same(slices.row_positions(skewed, ["segment_id"], ORDER, "p", limit), plain)


@pytest.mark.parametrize("limit", [3, 60])
def test_lookback_reaches_over_several_slices(skewed, limit):
    def columns(w):
        return {
            "a": F.lag("avg_speed_kmh", 2).over(w),
            "b": F.lag("avg_speed_kmh", 48).over(w),
            "n": F.count("*").over(w.rowsBetween(-5, 0)),
        }

    plain = skewed.withColumns(columns(Window.partitionBy("segment_id").orderBy(*ORDER)))
    sliced = slices.over_preceding_rows(skewed, "segment_id", ORDER, 48, ["avg_speed_kmh"], columns, limit)
    assert same(sliced, plain)


def test_running_offsets_in_parts(skewed):
    sizes = skewed.groupBy("segment_id").agg(F.count("*").alias("n"))
    whole = slices.running_offsets(sizes, ["segment_id"], "n", "start")
    parts = slices.running_offsets(sizes, ["segment_id"], "n", "start", one_task_rows=0)
    assert same(whole, parts)


def test_wall_micros_ignores_the_session_zone(spark):
    text = "2024-03-10 02:30:00.000001"
    df = spark.sql(f"SELECT TIMESTAMP_NTZ '{text}' AS t")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        value = df.select(slices.as_number(df, "t")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert value == 1710037800000001
