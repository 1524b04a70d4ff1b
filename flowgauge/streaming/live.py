"""Status, hourly statistics and scoring on a stream of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowgauge.operators.scoring import score
from flowgauge.operators.status import STATUS_COLUMNS, latest_per_key
from flowgauge.session import dealt

BATCH = "batch_id"
#: After so many batches the changes are merged into one table by key.
COMPACT_EVERY = 50


def _written(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches that are completely written below ``path``, rising."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = [status.getPath() for status in files.listStatus(folder)]
    return sorted(
        int(p.getName().partition("=")[2])
        for p in found
        if p.getName().startswith(f"{BATCH}=") and files.exists(hadoop.Path(p, "_SUCCESS"))
    )


def _forget(spark: SparkSession, path: str, batches: Sequence[int]) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    for n in batches:
        folder = hadoop.Path(f"{path}/{BATCH}={n}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _current(spark: SparkSession, path: str, upto: int | None, before: int | None, newest) -> DataFrame:
    """The newest row per key from the last merged table below ``before`` and the changes since."""
    merged = [n for n in _written(spark, f"{path}/merged") if before is None or n < before]
    since = merged[-1] if merged else -1
    changes = [n for n in _written(spark, f"{path}/changes") if n > since and (upto is None or n <= upto)]
    folders = [f"{path}/merged/{BATCH}={since}"] * bool(merged) + [f"{path}/changes/{BATCH}={n}" for n in changes]
    if not folders:
        raise FileNotFoundError(f"no status at {path} yet")
    return newest(spark.read.parquet(*folders))


def start_status(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    *,
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
    columns: Sequence[str] = STATUS_COLUMNS,
    compact_every: int = COMPACT_EVERY,
    **trigger,
) -> StreamingQuery:
    """Keep the newest reading of every key up to date below ``path``.

    The newest reading is a streaming aggregate, so a late older reading
    changes nothing. Each batch writes the keys it changed to its own folder;
    a repeated batch overwrites that folder and adds nothing. Every
    ``compact_every`` batches the changes are merged with the last merged
    table into a new one of a row per key. The merged table before it and its
    changes stay for readers that have begun, and older folders go, so neither
    a read nor the folder grows with the life of the stream.
    """
    newest = F.max_by(F.struct(*dict.fromkeys([*columns, ts, tie])), F.struct(ts, tie))
    changed = readings.groupBy(key).agg(newest.alias("_newest")).select(key, "_newest.*")

    def newest_of(rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, key, ts, tie, [*dict.fromkeys([*columns, ts, tie])])

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/{BATCH}={batch_id}")
        if (batch_id + 1) % compact_every:
            return
        spark = batch.sparkSession
        merged = _current(spark, path, batch_id, batch_id, newest_of)
        merged.write.mode("overwrite").parquet(f"{path}/merged/{BATCH}={batch_id}")
        kept = [n for n in _written(spark, f"{path}/merged") if n < batch_id][-1:]
        if kept:
            _forget(spark, f"{path}/merged", [n for n in _written(spark, f"{path}/merged") if n < kept[0]])
            _forget(spark, f"{path}/changes", [n for n in _written(spark, f"{path}/changes") if n <= kept[0]])

    return (
        changed.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def read_status(
    spark: SparkSession,
    path: str,
    *,
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
    columns: Sequence[str] = STATUS_COLUMNS,
) -> DataFrame:
    """The current status of every key from the last merged table and the changes since."""
    return _current(spark, path, None, None, lambda rows: latest_per_key(rows, key, ts, tie, columns))


def hourly_windows(
    readings: DataFrame,
    *,
    ts: str = "recorded_at",
    late: str = "10 minutes",
    width: str = "1 hour",
    by: Sequence[str] = (),
) -> DataFrame:
    """Mean level, mean speed and rows of each window, for a stream or a table.

    On a stream in append mode a window comes out once, when ``late`` has
    passed after its end; readings later than that are dropped.
    """
    return (
        readings.withWatermark(ts, late)
        .groupBy(F.window(ts, width).alias("window"), *by)
        .agg(
            F.avg("congestion_level").alias("avg_congestion"),
            F.avg("avg_speed_kmh").alias("avg_speed"),
            F.count(F.lit(1)).alias("record_count"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *by,
            "avg_congestion",
            "avg_speed",
            "record_count",
        )
    )


def score_stream(requests: DataFrame, model: PipelineModel, carry: Sequence[str] = ()) -> DataFrame:
    """Scored requests; the model is stateless, so this works row by row."""
    return score(dealt(requests), model, carry=carry)


def start_append(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write finished rows of a stream to parquet, exactly once."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )
