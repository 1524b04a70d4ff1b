"""The test tables read as segments, districts, readings and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions import codes
from flowgauge.session import dealt

EVENT_WEATHER = {"view": "clear", "click": "rain", "purchase": "heavy_rain", "signup": "fog"}

SPECIAL_EVENTS = [
    ("new_year", "holiday", "2024-01-01 00:00:00", "2024-01-02 06:00:00", 3),
    ("night_race", "sport", "2024-01-12 18:00:00", "2024-01-14 23:30:00", 3),
    ("travel_fair", "concert", "2024-01-13 09:00:00", "2024-01-13 21:00:00", 2),
    ("marathon", "sport", "2024-01-21 00:00:00", "2024-01-21 00:00:00", 2),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_readings(events: DataFrame) -> DataFrame:
    ts, value = F.col("ts"), F.col("value")
    vehicles = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("segment_id"),
        ts.alias("recorded_at"),
        F.hour(ts).alias("hour"),
        F.weekday(ts).alias("day_of_week"),
        F.month(ts).alias("month"),
        ts.cast("date").isin(
            *[F.lit(d).cast("date") for d in ("2024-01-01", "2024-02-08")]
        ).alias("is_holiday"),
        codes.lookup(F.col("event_type"), EVENT_WEATHER).alias("weather_condition"),
        F.when(F.col("event_id") % 17 != 0, value).alias("avg_speed_kmh"),
        F.when(F.col("event_id") % 23 != 0, vehicles).alias("vehicle_count"),
        codes.speed_to_level(value).alias("congestion_level"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "events"))


def dealt_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings, dealt evenly before anything is made of a row group's events."""
    return as_readings(dealt(table(spark, sf_dir, "events")))


def reading_stream(
    spark: SparkSession, folder: str, files: str = "events.parquet", **options
) -> DataFrame:
    """The event files of a folder as a stream; times become zoned, as watermarks ask."""
    schema = spark.read.option("pathGlobFilter", files).parquet(folder).schema
    events = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", files)
        .options(**options)
        .parquet(folder)
    )
    return as_readings(events).withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("segment_id"),
        F.col("c_nationkey").cast("int").alias("district_code"),
        F.col("c_name").alias("street_name"),
        F.col("c_mktsegment").alias("road_type"),
        (2 + 2 * (F.col("c_custkey") % 4)).cast("int").alias("lanes"),
    )


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("code"),
        F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("region"),
    )


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label/prediction pairs for the metric operators."""
    return table(spark, sf_dir, "labels").select(
        F.col("quality").alias("label"), F.col("toxic").alias("prediction")
    )


def literal_table(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A small fixed table whose size Spark knows, so that it may be broadcast."""
    values = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")


def holidays(spark: SparkSession) -> DataFrame:
    days = literal_table(spark, [(d,) for d in codes.HOLIDAYS_2024], "day")
    return days.select(F.col("day").cast("date").alias("day"))


def special_events(spark: SparkSession) -> DataFrame:
    rows = literal_table(
        spark, SPECIAL_EVENTS, "event_name, event_type, start_time, end_time, impact_level"
    )
    return rows.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("start_time", "end_time")}
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading as a scoring request, dealt evenly as scoring needs no shuffle; some break the rules."""
    return dealt_readings(spark, sf_dir).select(
        "id",
        "segment_id",
        "recorded_at",
        "hour",
        "day_of_week",
        "month",
        "is_holiday",
        "weather_condition",
        "avg_speed_kmh",
        "vehicle_count",
        (F.col("id") % 12).cast("int").alias("lanes"),
    )
