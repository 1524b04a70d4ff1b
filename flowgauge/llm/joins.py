"""Joins that spread keys held by many rows, whatever Spark's settings are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.session import settle

#: Keys that hold more than one row in ``SHARE`` are joined by broadcast; there can't be more than ``SHARE`` of them.
SHARE = 1000
#: Rows of one key that meet in one task in ``spread_join``.
ROWS_PER_COPY = 512


def counted_join(left: DataFrame, right: DataFrame, on: list[str], weight: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right``, which has one narrow row per key.

    ``weight`` is the column of ``right`` with the number of rows of ``left``
    that hold its key. The rows of keys with more than one row in ``SHARE``
    stay where they are and meet at most ``SHARE`` broadcast rows; all others
    are merged, so no task gets more than that share of one key. ``how`` is
    inner or left; a NULL key finds nothing. Both tables are read more than
    once and should be written ones.
    """
    total = right.agg(F.sum(weight).alias("n")).first()["n"] or 0
    is_heavy = F.col(weight) * SHARE > F.lit(total)
    heavy, light = right.filter(is_heavy), right.filter(~is_heavy)
    here = left.join(F.broadcast(heavy), on)
    rest = left.join(F.broadcast(heavy.select(*on)), on, "left_anti")
    return here.unionByName(rest.join(light.hint("merge"), on, how))


def spread_join(left: DataFrame, right: DataFrame, key: str, rows: int = ROWS_PER_COPY) -> DataFrame:
    """Inner join of ``left`` (a written, narrow table, many rows of a key) with ``right`` (wide, one row per key).

    The row of ``right`` whose key has more than one row of ``left`` in
    ``SHARE`` is copied once for every ``rows`` of them, and these are dealt
    over the copies, so a key with very many partners is shared by many tasks.
    """
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    least = max(rows, left.count() // SHARE)
    often = F.broadcast(settle(counts.filter(F.col("_n") > least)))  # at most SHARE keys
    copies = F.coalesce(F.ceil(F.col("_n") / F.lit(rows)), F.lit(1))
    copied = right.join(often, key, "left")
    copied = copied.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), copies - 1))).drop("_n")
    dealt = left.join(often, key, "left").withColumn("_copy", F.pmod(F.xxhash64(*left.columns), copies)).drop("_n")
    return dealt.join(copied.hint("merge"), [key, "_copy"]).drop("_copy")
