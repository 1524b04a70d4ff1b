"""Train/test splits and cross-validation folds."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.operators.quantiles import exact_quantiles, values_at_ranks
from flowgauge.operators.slices import (
    SLICE_ROWS,
    as_number,
    join_groups,
    row_positions,
    running_offsets,
)
from flowgauge.session import settle

SORTED_ROWS = 200_000


def _time_literal(df: DataFrame, ts: str, micros: int) -> Column:
    moment = datetime(1970, 1, 1) + timedelta(microseconds=micros)
    kind = df.schema[ts].dataType.simpleString()
    zone = "" if kind == "timestamp_ntz" else "+00:00"
    return F.lit(moment.isoformat(sep=" ") + zone).cast(kind)


def _row_at(df: DataFrame, rank: int, rows: int, ts: str, tie: str) -> tuple[Column, int]:
    """Time and id of the row at a rank by (time, id); few rows are just sorted."""
    if rows <= SORTED_ROWS:
        row = df.select(ts, tie).orderBy(ts, tie).offset(rank).limit(1).first()
        zoneless = df.schema[ts].dataType.simpleString() == "timestamp_ntz"
        moment = F.lit(str(row[ts])).cast("timestamp_ntz") if zoneless else F.lit(row[ts])
        return moment, row[tie]
    at = values_at_ranks(df, {"t": as_number(df, ts)}, [("t", rank)])["t", rank]
    moment = _time_literal(df, ts, int(at))
    rank -= df.filter(F.col(ts) < moment).count()
    ties = df.filter(F.col(ts) == moment)
    if not isinstance(df.schema[tie].dataType, T.IntegralType):  # a number would not tell all ids apart
        return moment, ties.select(tie).orderBy(tie).offset(rank).limit(1).first()[tie]
    first = values_at_ranks(ties, {"i": as_number(df, tie)}, [("i", rank)])["i", rank]
    return moment, int(first)


def positional_rule(
    df: DataFrame,
    test_ratio: float = 0.2,
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
) -> Column:
    """True for the first ``int(n * (1 - test_ratio))`` rows by (key, time, id).

    Rows are counted per key, the key holding the cut is found from the
    counts, and the cut row inside that key. What is left is a comparison with
    that row: no row of ``df`` is moved or numbered.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    starts = running_offsets(counts, [key], "n", "start")
    rows = starts.agg(F.sum("n")).first()[0] or 0
    rank = int(rows * (1 - test_ratio))
    row = starts.filter((F.col("start") <= rank) & (rank < F.col("start") + F.col("n"))).first()
    if row is None:
        return F.lit(True)
    k, t = F.col(key), F.col(ts)
    if row[key] is None:
        at_key, before = k.isNull(), F.lit(False)
    else:
        at_key, before = k == F.lit(row[key]), k.isNull() | (k < F.lit(row[key]))
    moment, first = _row_at(df.filter(at_key), rank - row["start"], row["n"], ts, tie)
    earlier = t.isNull() | (t < moment) | ((t == moment) & (F.col(tie) < first))
    return before | (at_key & earlier)


def chronological_rule(
    df: DataFrame, test_ratio: float = 0.2, ts: str = "recorded_at", **options
) -> Column:
    """True for rows before the exact ``1 - test_ratio`` quantile of the times."""
    p = 1 - test_ratio
    at = exact_quantiles(df, {"t": [p]}, {"t": as_number(df, ts)}, **options)["t", p]
    if at is None:
        return F.lit(True)
    return F.col(ts).isNull() | (F.col(ts) < _time_literal(df, ts, math.ceil(at)))


def split(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """(train, test): the rows a rule accepts, and the rest."""
    return df.filter(rule), df.filter(~rule)


def tag_sets(df: DataFrame, rule: Column) -> DataFrame:
    """All rows, told apart by ``set``."""
    return df.withColumn("set", F.when(rule, "TRAIN").otherwise("TEST"))


def _add_starts(placed: DataFrame, starts: DataFrame, names: list[str]) -> DataFrame:
    """Join the counted groups; plainly, if no group has a NULL, so that rows
    already partitioned by the group need no second shuffle."""
    missing = F.lit(False)
    for name in names:
        missing = missing | F.col(name).isNull()
    if starts.filter(missing).isEmpty():
        return placed.join(starts, names)
    return join_groups(placed, starts, names)


def global_positions(
    df: DataFrame,
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
    out: str = "position",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """0-based position of each row in the table ordered by (key, time, id)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    starts = running_offsets(counts, [key], "_n", "_start")
    largest = starts.agg(F.max("_n")).first()[0] or 0
    placed = row_positions(df, [key], [ts, tie], out, slice_rows, largest)
    return (
        _add_starts(placed, starts.drop("_n"), [key])
        .withColumn(out, F.col(out) + F.col("_start"))
        .drop("_start")
    )


def stratified_folds(
    df: DataFrame,
    k: int,
    label: str = "congestion_level",
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
    out: str = "fold",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Unshuffled stratified folds 0..k-1 over the (key, time, id) order.

    Classes are laid end to end in order of their first row, place j counts
    for fold ``j % k``, and each class fills its folds with blocks of rows in
    order. A class may be most of the table: rows are placed per (class, key),
    and only row counts are summed per class. Where a class ends in each fold
    is a small table that the rows are joined with, however many classes there
    are.
    """
    counts = settle(
        df.groupBy(label, key).agg(
            F.count(F.lit(1)).alias("_n"), F.min(F.struct(ts, tie)).alias("_first")
        )
    )
    classes = counts.groupBy(label).agg(
        F.sum("_n").alias("_rows"),
        F.max("_n").alias("_largest"),
        F.min(F.struct(F.col(key).alias("k"), F.col(f"_first.{ts}").alias("t"), F.col(f"_first.{tie}").alias("i"))).alias("_at"),
    )
    classes = classes.select(label, "_rows", "_largest", "_at.k", "_at.t", "_at.i")
    laid = running_offsets(classes, ["k", "t", "i"], "_rows", "_place")

    def rows_in(f: int) -> Column:
        """Rows of a class whose places count for fold ``f``."""
        upto = F.col("_place") + F.col("_rows")
        return F.floor((upto - f + k - 1) / k) - F.floor((F.col("_place") - f + k - 1) / k)

    ends = F.array(*[sum((rows_in(g) for g in range(1, f + 1)), rows_in(0)) for f in range(k - 1)])
    ends = settle(laid.select(label, ends.cast("array<bigint>").alias("_ends"), "_largest"))

    starts = running_offsets(counts.drop("_first"), [key], "_n", "_start", by=[label]).drop("_n")
    largest = ends.agg(F.max("_largest")).first()[0] or 0
    placed = row_positions(df, [label, key], [ts, tie], "_pos", slice_rows, largest)
    placed = _add_starts(placed, starts, [label, key])
    placed = _add_starts(placed, ends.drop("_largest"), [label])
    pos = F.col("_pos") + F.col("_start")
    fold = F.size(F.filter("_ends", lambda end: pos >= end)) if k > 1 else F.lit(0)
    return placed.select(*df.columns, fold.alias(out))
