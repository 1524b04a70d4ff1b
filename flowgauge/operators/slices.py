"""Order-preserving slices of hot groups.

A window over ``partitionBy(key)`` puts all rows of a key into one task. Where
a key holds more than ``SLICE_ROWS`` rows, the operators here cut its ordered
rows into slices and work on (key, slice) instead:

* ``slice_hot_groups`` adds the slice of each row. Slices of a group are
  ordered like the rows themselves, so slice by slice is still in order.
* ``running_offsets`` gives the rows that lie in earlier slices.
* ``row_positions`` is an exact ``row_number`` that never needs a whole group.
* ``over_preceding_rows`` runs lag / rolling windows with the few rows before
  each slice copied into it.

A table without hot groups keeps the plain window plan; finding that out costs
one partial aggregation on the key column, or nothing where the caller already
knows a bound for the rows of the largest group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.session import settle

SLICE_ROWS = 1_000_000
_SLICE = "_slice"
_SPREAD = 2


@dataclass
class Sliced:
    """Rows plus, where some group was hot, the slice column and slice sizes."""

    rows: DataFrame
    group: list[str]
    sizes: DataFrame | None = None

    @property
    def hot(self) -> bool:
        return self.sizes is not None

    @property
    def partition(self) -> list[str]:
        return [*self.group, _SLICE] if self.hot else list(self.group)

    def in_slices(self) -> DataFrame:
        """Rows of the hot groups only."""
        return self.rows.filter(F.size(_SLICE) > 0)

    def spread(self, rows: DataFrame) -> DataFrame:
        """``rows`` dealt out by (group, slice).

        A window by (group, slice) is content with rows that already lie
        together by group, say after a join, and would leave a hot group in one task.
        """
        return rows.repartition(*self.partition) if self.hot else rows

    def offsets(self) -> DataFrame:
        """Per slice: its rows ``_size`` and the group's rows before it ``_before``."""
        w = Window.partitionBy(*self.group).orderBy(_SLICE)
        before = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1))
        return self.sizes.select(
            *self.partition, F.col("_n").alias("_size"), F.coalesce(before, F.lit(0)).alias("_before")
        )


def names_apart(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns that begin with an underscore renamed, and the old name of each new one.

    Columns made on the way begin with an underscore here, so they never meet the user's.
    """
    taken, back = {c.lower() for c in df.columns}, {}
    for name in (c for c in df.columns if c.startswith("_")):
        new = f"own{name}"
        while new.lower() in taken:
            new = f"own{new}"
        taken.add(new.lower())
        back[new] = name
    return df.withColumnsRenamed({old: new for new, old in back.items()}), back


def wall_micros(ts: Column) -> Column:
    """Microseconds of a zone-less time, independent of the session time zone."""
    minutes = (F.unix_date(ts.cast("date")).cast("bigint") * 24 + F.hour(ts)) * 60 + F.minute(ts)
    seconds = F.extract(F.lit("SECOND"), ts)
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def as_number(df: DataFrame, name: str) -> Column:
    """Order column as a bigint that never falls where the column rises.

    Microseconds for times, itself for integers; other numbers lose their
    fraction and strings all but their first seven bytes, so different values
    may share a number.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return wall_micros(F.col(name))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("bigint")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.substring(F.hex(F.encode(F.col(name), "utf-8")), 1, 14), 14, "0")
        return F.conv(head, 16, 10).cast("bigint")
    if isinstance(kind, T.DoubleType | T.FloatType | T.DecimalType):
        number = F.col(name).cast("double")
        within = F.greatest(F.least(number, F.lit(9e18)), F.lit(-9e18))  # NaN is the largest
        return F.when(F.isnan(number), F.lit(2**63 - 1)).otherwise(within.cast("bigint"))
    return F.col(name).cast("bigint")


def join_groups(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns where NULL equals NULL, as in ``groupBy``."""
    twins = right.select(*[F.col(c).alias(f"_r_{c}" if c in names else c) for c in right.columns])
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).eqNullSafe(F.col(f"_r_{name}"))
    return left.join(twins, cond, how).drop(*[f"_r_{n}" for n in names])


def group_sizes(df: DataFrame, group: Sequence[str]) -> tuple[int, int]:
    """(rows of the table, rows of its largest group), reading the keys only."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    row = sizes.agg(F.sum("n").alias("rows"), F.max("n").alias("largest")).first()
    return row["rows"] or 0, row["largest"] or 0


def _sizes(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    stats = [F.count(F.lit(1)).alias("_n")]
    for i, name in enumerate(order):
        number = as_number(rows, name)
        stats += [F.min(number).alias(f"_lo{i}"), F.max(number).alias(f"_hi{i}")]
    return rows.groupBy(*by).agg(*stats)


def _too_full(sizes: DataFrame, order: list[str], limit: int) -> DataFrame:
    """Groups above the limit that some order column can still cut."""
    varies = F.lit(False)
    for i in range(len(order)):
        varies = varies | (F.col(f"_lo{i}") < F.col(f"_hi{i}"))
    return sizes.filter((F.col("_n") > limit) & varies)


def slice_hot_groups(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    slice_rows: int = SLICE_ROWS,
    largest: int | None = None,
) -> Sliced:
    """Cut every group of more than ``slice_rows`` rows along ``order``.

    Each round cuts the slices that are still too full into equal ranges of
    the first order column that varies inside them, so bursts get finer cuts
    and rows with one time are cut by the next column. The cut table holds at
    most (rows / slice_rows) entries. ``largest`` is a known bound for the
    rows of any group.
    """
    group, order = list(group), list(order)
    if largest is None:
        _, largest = group_sizes(df, group)
    if largest <= slice_rows:
        return Sliced(df, group)

    whole = F.array().cast("array<bigint>")
    cuts = settle(_too_full(_sizes(df, group, order), order, slice_rows))
    if cuts.isEmpty():
        return Sliced(df, group)
    rows, cuts = df.withColumn(_SLICE, whole), cuts.withColumn(_SLICE, whole)
    by = [*group, _SLICE]
    while True:
        rows = _cut(rows, cuts, by, order, slice_rows)
        sizes = settle(_sizes(rows.filter(F.size(_SLICE) > 0), by, order))
        cuts = _too_full(sizes, order, slice_rows)
        if cuts.isEmpty():
            return Sliced(rows, group, sizes)


def _cut(rows, cuts, by, order, slice_rows) -> DataFrame:
    parts = F.ceil(F.col("_n") * F.lit(_SPREAD) / F.lit(slice_rows)).cast("bigint")
    cuts = cuts.withColumn("_parts", F.greatest(parts, F.lit(2).cast("bigint")))

    piece = None
    for i, name in enumerate(order):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        share = (as_number(rows, name) - lo).cast("decimal(38,0)") * F.col("_parts")
        nth = F.floor(share / (hi - lo + F.lit(1).cast("decimal(38,0)"))).cast("bigint")
        nth = F.coalesce(nth, F.lit(-1).cast("bigint"))
        piece = F.when(lo < hi, nth) if piece is None else piece.when(lo < hi, nth)
    finer = F.when(F.col("_n").isNotNull(), F.concat(F.col(_SLICE), F.array(piece)))
    keep = [c for c in rows.columns if c != _SLICE]
    return join_groups(rows, cuts, by, "left").select(
        *keep, F.coalesce(finer, F.col(_SLICE)).alias(_SLICE)
    )


def running_offsets(
    table: DataFrame,
    order: Sequence[str],
    value: str,
    out: str,
    by: Sequence[str] = (),
    one_task_rows: int = 1_000_000,
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of an aggregated table.

    Up to ``one_task_rows`` rows a plain window does it. Beyond that the table
    is range-partitioned, each part is summed by itself, and only the totals
    of the parts are summed in order.
    """
    by, order = list(by), list(order)
    earlier = (Window.unboundedPreceding, -1)

    def before(partition, ordering):
        w = Window.partitionBy(*partition).orderBy(*ordering).rowsBetween(*earlier)
        return F.coalesce(F.sum(value).over(w), F.lit(0))

    table = settle(table)
    if table.count() <= one_task_rows:
        return table.withColumn(out, before(by, order))

    parts = settle(
        table.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id())
    )
    totals = parts.groupBy(*by, "_part").agg(F.sum(value).alias(value))
    totals = totals.withColumn("_base", before(by, ["_part"])).drop(value)
    inner = parts.withColumn("_inner", before([*by, "_part"], order))
    return (
        inner.join(totals, [*by, "_part"])
        .withColumn(out, F.col("_inner") + F.col("_base"))
        .drop("_inner", "_base", "_part")
    )


def row_positions(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    out: str,
    slice_rows: int = SLICE_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """0-based position of each row in its group, as ``row_number() - 1``."""
    sliced = slice_hot_groups(df, group, order, slice_rows, largest)
    w = Window.partitionBy(*sliced.partition).orderBy(*order)
    number = F.row_number().over(w).cast("bigint") - 1
    if not sliced.hot:
        return df.withColumn(out, number)
    numbered = sliced.spread(sliced.rows).withColumn(out, number)
    placed = join_groups(numbered, sliced.offsets().drop("_size"), sliced.partition, "left")
    position = F.col(out) + F.coalesce(F.col("_before"), F.lit(0))
    return placed.select(*[c for c in df.columns if c != out], position.alias(out))


def over_preceding_rows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    back: int,
    uses: Sequence[str],
    columns: Callable[[WindowSpec], dict[str, Column]],
    slice_rows: int = SLICE_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Window columns that look at most ``back`` rows behind the current row.

    ``columns`` maps the ordered window to the new columns, which read the
    columns ``uses``. One shuffle on the key, or on (key, slice) with the last
    ``back`` rows before each slice copied into it.
    """
    sliced = slice_hot_groups(df, [key], order, slice_rows, largest)
    window = Window.partitionBy(*sliced.partition).orderBy(*order)
    if not sliced.hot:
        return df.withColumns(columns(window))

    offsets = sliced.offsets()
    latest_first = Window.partitionBy(*sliced.partition).orderBy(*[F.col(c).desc() for c in order])
    tails = (
        sliced.spread(sliced.in_slices().select(*dict.fromkeys([*sliced.partition, *order, *uses])))
        .withColumn("_rn", F.row_number().over(latest_first))
        .filter(F.col("_rn") <= back)
    )
    tails = (
        join_groups(tails, offsets, sliced.partition)
        .withColumn("_pos", F.col("_before") + F.col("_size") - F.col("_rn"))
        .drop(_SLICE, "_rn", "_size", "_before")
    )
    first = F.greatest(F.col("_before") - back, F.lit(0))
    wanted = offsets.filter("_before > 0").select(
        key, _SLICE, F.explode(F.sequence(first, F.col("_before") - 1)).alias("_pos")
    )
    copies = join_groups(tails, wanted, [key, "_pos"]).drop("_pos").withColumn("_copy", F.lit(True))
    rows = sliced.rows.withColumn("_copy", F.lit(False))
    rows = sliced.spread(rows.unionByName(copies, allowMissingColumns=True))
    return rows.withColumns(columns(window)).filter(~F.col("_copy")).drop("_copy", _SLICE)
