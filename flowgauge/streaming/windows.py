"""Windowed statistics of a stream that late readings correct, with the late readings as a side output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowgauge.streaming.live import BATCH, _forget, _written

#: After so many batches the sums are published and older batches are forgotten.
PUBLISH_EVERY = 50
_SUMS = ("level_sum", "n_level", "speed_sum", "n_speed", "record_count", "n_late")


def _watermark(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """Microseconds up to which windows were closed when batch ``before`` began (None: by now)."""
    done = [n for n in _written(spark, f"{path}/marks") if before is None or n < before]
    return spark.read.parquet(f"{path}/marks/{BATCH}={done[-1]}").first()["watermark"] if done else None


def _is_closed(end: Column, watermark: int | None) -> Column:
    return F.lit(False) if watermark is None else F.unix_micros(end) <= F.lit(watermark)


def _batch_sums(rows: DataFrame, is_late: Column, level: str, speed: str, by: Sequence[str]) -> DataFrame:
    """Sums of one batch per window, from rows ``w`` (window) and ``r`` (reading)."""
    level_value, speed_value = F.col(f"r.`{level}`"), F.col(f"r.`{speed}`").cast("double")
    sums = rows.groupBy("w", *[F.col(f"r.`{name}`").alias(name) for name in by]).agg(
        F.sum(level_value.cast("bigint")).alias("level_sum"),
        F.count(level_value).alias("n_level"),
        F.sum(speed_value).alias("speed_sum"),
        F.count(speed_value).alias("n_speed"),
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(is_late).alias("n_late"),
    )
    days = F.expr("CAST(unix_seconds(w.start) DIV 86400 AS INT)")  # days of UTC, whatever the session's zone
    date = F.date_from_unix_date(days).cast("string").alias("date")
    return sums.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, *_SUMS, date)


def _added(parts: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("window_start", "window_end", *by, "date").agg(*[F.sum(c).alias(c) for c in _SUMS])


def _published(spark: SparkSession, path: str, upto: int | None = None) -> dict[str, int]:
    """date -> the last complete publication (of batch ``upto`` at most) that holds its windows."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    found = {}
    for n in _written(spark, f"{path}/windows"):
        if upto is None or n <= upto:
            folder = hadoop.Path(f"{path}/windows/{BATCH}={n}")
            for status in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder):
                name, _, date = status.getPath().getName().partition("=")
                if name == "date":
                    found[date] = n
    return found


def _sums_of(spark: SparkSession, path: str, held: dict[str, int]) -> list[DataFrame]:
    """The published sums of the given dates; files of other dates are not read."""
    parts = []
    for n in sorted(set(held.values())):
        folder = f"{path}/windows/{BATCH}={n}"
        dates = [f"{folder}/date={date}" for date, at in held.items() if at == n]
        rows = spark.read.option("basePath", folder).parquet(*dates)
        parts.append(rows.withColumn("date", F.col("date").cast("string")))
    return parts


def _since(spark: SparkSession, path: str, published: int, upto: int | None = None) -> list[DataFrame]:
    """The sums of the batches after a publication."""
    batches = [n for n in _written(spark, f"{path}/batches") if n > published and (upto is None or n <= upto)]
    return [spark.read.parquet(*[f"{path}/batches/{BATCH}={n}" for n in batches])] if batches else []


def publish(spark: SparkSession, path: str, upto: int, by: Sequence[str] = ()) -> None:
    """Rewrite the windows of the dates that batches up to ``upto`` touched since the last publication.

    Each publication is a folder of its own and counts once it is complete, so
    one that dies half way changes nothing and may run again. What readers of
    the last publication may have begun to read stays; what was replaced
    before that goes.
    """
    before = [n for n in _written(spark, f"{path}/windows") if n < upto]
    last = before[-1] if before else -1
    fresh = _since(spark, path, last, upto)
    if not fresh:
        return
    touched = {r["date"] for r in fresh[0].select("date").distinct().collect()}  # one value per calendar day
    held = {date: n for date, n in _published(spark, path, last).items() if date in touched}
    total = _added([*fresh, *_sums_of(spark, path, held)], by)
    side = [f"{path}/late/{BATCH}={n}" for n in _written(spark, f"{path}/late") if last < n <= upto]
    spark.read.parquet(*side).write.mode("overwrite").parquet(f"{path}/late_log/{BATCH}={upto}")
    total.write.mode("overwrite").partitionBy("date").parquet(f"{path}/windows/{BATCH}={upto}")

    for name in ("batches", "late"):
        _forget(spark, f"{path}/{name}", [n for n in _written(spark, f"{path}/{name}") if n <= last])
    _forget(spark, f"{path}/marks", [n for n in _written(spark, f"{path}/marks") if n < last])
    current = set(_published(spark, path, last).values())
    _forget(spark, f"{path}/windows", [n for n in before if n < last and n not in current])


def start_windows(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    *,
    ts: str = "recorded_at",
    late: str = "10 minutes",
    width: str = "1 hour",
    level: str = "congestion_level",
    speed: str = "avg_speed_kmh",
    by: Sequence[str] = (),
    publish_every: int = PUBLISH_EVERY,
    **trigger,
) -> StreamingQuery:
    """Windowed sums of a stream below ``path``; no reading is lost for being late.

    A window is closed once ``late`` has passed after its end by the newest
    reading of the batches before. A reading for a closed window goes to the
    side output (``read_late``) and into the window's sums all the same, so
    ``read_windows`` shows the corrected window and how many late readings it
    holds. A reading without a time belongs to no window and only goes to the
    side output.

    A batch writes one row per window and ``by`` value to its own folder, so a
    repeated batch overwrites what it wrote. The stream keeps no state in
    executors: late readings of any age cost one row, and only the dates that
    they touch are written again (``publish``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = _watermark(spark, path, batch_id)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            time = F.col(ts).cast("timestamp")
            rows = batch.select(F.struct("*").alias("r"), time.alias("t")).select("r", F.window("t", width).alias("w"))
            is_late = _is_closed(F.col("w.end"), before)
            side = rows.filter(is_late).select("r.*").unionByName(batch.filter(F.col(ts).isNull()))
            side.write.mode("overwrite").parquet(f"{path}/late/{BATCH}={batch_id}")
            sums = _batch_sums(rows, is_late, level, speed, by)
            sums.write.mode("overwrite").parquet(f"{path}/batches/{BATCH}={batch_id}")
            newest = F.unix_micros(F.max(time) - F.expr(f"INTERVAL {late}"))
            mark = batch.agg(F.greatest(newest, F.lit(before).cast("bigint")).alias("watermark"))
            mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/{BATCH}={batch_id}")
        finally:
            batch.unpersist()
        if (batch_id + 1) % publish_every == 0:
            publish(spark, path, batch_id, by)

    return (
        readings.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def read_windows(spark: SparkSession, path: str, by: Sequence[str] = ()) -> DataFrame:
    """The closed windows with all readings that have come, and ``n_late``, those that came after it was closed."""
    published = _written(spark, f"{path}/windows")
    last = published[-1] if published else -1
    parts = [*_sums_of(spark, path, _published(spark, path, last)), *_since(spark, path, last)]
    if not parts:
        raise FileNotFoundError(f"no windows at {path} yet")
    closed = _added(parts, by).filter(_is_closed(F.col("window_end"), _watermark(spark, path)))
    return closed.select(
        "window_start",
        "window_end",
        *by,
        F.try_divide("level_sum", "n_level").alias("avg_congestion"),
        F.try_divide("speed_sum", "n_speed").alias("avg_speed"),
        "record_count",
        "n_late",
    )


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """The readings that came after their window was closed, and those without a time."""
    published = _written(spark, f"{path}/windows")
    last = published[-1] if published else -1
    folders = [f"{path}/late_log/{BATCH}={n}" for n in _written(spark, f"{path}/late_log") if n <= last]
    folders += [f"{path}/late/{BATCH}={n}" for n in _written(spark, f"{path}/late") if n > last]
    if not folders:
        raise FileNotFoundError(f"no batches at {path} yet")
    return spark.read.parquet(*folders)
