"""Declared constraints as checks over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.session import settle

READING_RANGES = {"hour": (0, 23), "day_of_week": (0, 6), "month": (1, 12)}

REQUEST_RANGES = {
    "hour": (0, 23),
    "day_of_week": (0, 6),
    "month": (1, 12),
    "avg_speed_kmh": (0, 120),
    "vehicle_count": (0, None),
    "lanes": (1, 10),
}
REQUEST_REQUIRED = ("segment_id", "hour", "day_of_week", "month")


def _outside(name: str, low, high) -> Column:
    """True where a value breaks the range; NULL passes, as in a CHECK."""
    below = F.col(name) < low if low is not None else F.lit(False)
    above = F.col(name) > high if high is not None else F.lit(False)
    return F.coalesce(below | above, F.lit(False))


def _counted(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row per check with its violations, all counted in one pass."""
    names = list(checks)
    counts = df.agg(*[F.count_if(checks[n]).alias(n) for n in names])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("n_violations")) for n in names]
    )
    return counts.select(F.inline(pairs))


def range_violations(df: DataFrame, ranges: Mapping[str, tuple] = READING_RANGES) -> DataFrame:
    return _counted(df, {n: _outside(n, lo, hi) for n, (lo, hi) in ranges.items()})


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _counted(df, {n: F.col(n).isNull() for n in columns})


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; NULL keys are no duplicates."""
    rows = df.dropna(subset=list(key))
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphan_keys(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Foreign key values without a dimension row, with their row counts.

    The fact rows are counted per key before the join, so a hot key costs one
    row there. NULL keys pass.
    """
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    known = dim.select(F.col(dim_key).alias(key))
    return used.join(known, key, "left_anti")


def orphan_rows(fact: DataFrame, key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """The fact rows behind ``orphan_keys``."""
    return fact.join(orphan_keys(fact, key, dim, dim_key).select(key), key, "left_semi")


#: Keys that occur more than once, up to which their rows are told apart before any row moves.
REPEATED_KEYS = 100_000


def keep_first(df: DataFrame, key: Sequence[str], tie: str | Column) -> DataFrame:
    """One row per key value, the one with the smallest ``tie``; NULL keys are equal to each other.

    Keys are counted first, which moves keys alone. With few repeated keys all
    other rows stay where they are, and only rows of repeated keys are
    compared; with many, all rows are. Both ways combine rows of a key before
    the shuffle and give the same rows.
    """
    repeated = settle(_repeated(df, key))
    if repeated.count() > REPEATED_KEYS:
        return _first_rows(df, key, tie)
    same = reduce(and_, [F.col(f"_rows.{k}").eqNullSafe(F.col(f"_repeated.k{i}")) for i, k in enumerate(key)])
    rows, repeated = df.alias("_rows"), repeated.alias("_repeated")
    several = rows.join(repeated, same, "left_semi")
    return rows.join(repeated, same, "left_anti").unionByName(_first_rows(several, key, tie))


def _first_rows(df: DataFrame, key: Sequence[str], tie: str | Column) -> DataFrame:
    first = F.min_by(F.struct(*df.columns), F.col(tie) if isinstance(tie, str) else tie)
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(first.alias("_r")).select("_r.*")


def _repeated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(k0, k1, ...): key values that occur more than once, also NULLs."""
    counts = df.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)]).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1").drop("n")


def request_errors(
    df: DataFrame,
    ranges: Mapping[str, tuple] = REQUEST_RANGES,
    required: Sequence[str] = REQUEST_REQUIRED,
) -> DataFrame:
    """Adds ``errors`` (messages, possibly none) and ``valid``."""
    found = [F.when(F.col(n).isNull(), F.lit(f"{n} is required")) for n in required]
    for name, (low, high) in ranges.items():
        text = f"{name} must be at least {low}" if high is None else (
            f"{name} must be between {low} and {high}"
        )
        found.append(F.when(_outside(name, low, high), F.lit(text)))
    return df.withColumn("errors", F.array_compact(F.array(*found))).withColumn(
        "valid", F.size("errors") == 0
    )


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) of ``request_errors``."""
    return (
        checked.filter("valid").drop("errors", "valid"),
        checked.filter(~F.col("valid")).drop("valid"),
    )
