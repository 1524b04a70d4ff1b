"""Exact quantiles and order statistics without gathering the values.

``percentile`` and ``median`` keep every distinct value of a column in one
buffer. That is used only where the rows, or the estimated distinct values, are
few enough. Beyond that two passes over the table answer all ranks of all
columns: a mergeable sketch per task brackets each rank between two values, and
the second pass counts the rows below each bracket and the values inside, of
which there are few. A rank that the sketch misses is found by counting rows of
the whole table in ever finer ranges.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.operators.slices import running_offsets
from flowgauge.session import settle

BUFFER_ROWS = 1_000_000
_BINS = 16_384
#: The sketch's ranks are off by at most one row in so many; a bracket reaches twice as far to either side.
_ACCURACY = 10_000


def _known(column: Column) -> Column:
    """The column as a double, with NaN as missing."""
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def _ends(names: Iterable[str]) -> list[Column]:
    return [F.struct(F.count(n), F.min(n), F.max(n)).alias(n) for n in names]


def values_at_ranks(
    df: DataFrame,
    columns: Mapping[str, Column],
    ranks: Iterable[tuple[str, int]],
    ends: Mapping[str, tuple] | None = None,
) -> dict[tuple[str, int], float]:
    """Value of each named column at each 0-based rank among its values; NULL and NaN are none."""
    values = df.select(*[_known(c).alias(n) for n, c in columns.items()])
    if ends is None:
        ends = values.agg(*_ends(columns)).first().asDict()
    # (column, rank) -> range known to hold it, and the rows below that range
    spans = {(n, r): (*ends[n][1:], 0) for n, r in ranks}
    while any(lo < hi for lo, hi, _ in spans.values()):
        spans = _narrow(values, spans)
    return {target: lo for target, (lo, _, _) in spans.items()}


def _narrow(values: DataFrame, spans: dict) -> dict:
    """One pass that cuts every open range and keeps the parts with the ranks."""
    ranges = sorted({(name, *span) for (name, _), span in spans.items() if span[0] < span[1]})

    def cut(i: int, name: str, lo: float, hi: float) -> Column:
        nth = F.floor((F.col(name) - F.lit(lo)) / (F.lit(hi) - F.lit(lo)) * _BINS).cast("int")
        return F.struct(
            F.lit(i).alias("i"),
            F.least(nth, F.lit(_BINS - 1)).alias("bin"),
            F.col(name).alias("v"),
        )

    parts = [(cut(i, n, lo, hi), F.col(n).between(lo, hi)) for i, (n, lo, hi, _) in enumerate(ranges)]
    if len(parts) == 1:
        ((part, inside),) = parts
        cuts = values.filter(inside).select(part.alias("h"))
    else:
        hits = F.array_compact(F.array(*[F.when(inside, part) for part, inside in parts]))
        cuts = values.select(F.explode(hits).alias("h"))
    bins = cuts.groupBy("h.i", "h.bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("h.v").alias("lo"), F.max("h.v").alias("hi")
    )
    w = Window.partitionBy("i").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(w), F.lit(0))

    asked = [
        (target, ranges.index((target[0], *span)), target[1] - span[2])
        for target, span in spans.items()
        if span[0] < span[1]
    ]
    holds = [
        F.when(
            (F.col("i") == i) & (F.col("before") <= left) & (left < F.col("before") + F.col("n")), j
        )
        for j, (_, i, left) in enumerate(asked)
    ]
    found = (
        bins.withColumn("before", before)
        .select("lo", "hi", "before", F.explode(F.array_compact(F.array(*holds))).alias("j"))
        .collect()
    )
    out = dict(spans)
    for row in found:
        target = asked[row["j"]][0]
        out[target] = (row["lo"], row["hi"], spans[target][2] + row["before"])
    return out


def _brackets(wanted: Mapping[str, list[float]]) -> list[Column]:
    """Per column one aggregate: the sketched values at both sides of each probability."""
    far = 2 / _ACCURACY
    return [
        F.percentile_approx(
            f"q_{n}", [p for q in ps for p in (max(q - far, 0.0), min(q + far, 1.0))], _ACCURACY
        ).alias(f"b_{n}")
        for n, ps in wanted.items()
        if ps
    ]


def _between_brackets(
    values: DataFrame, brackets: Mapping[tuple[str, int], tuple[float, float]]
) -> dict[tuple[str, int], float]:
    """Value of a column at each rank whose bracket holds it, from one pass that counts and keeps what is inside.

    ``brackets`` maps (column, rank) to two values. Equal values are combined
    before the shuffle, and values outside a bracket are only counted.
    """
    spans = sorted({(n, *ends) for (n, _), ends in brackets.items()})
    parts = []
    for i, (n, low, high) in enumerate(spans):
        at, low, high = F.col(n), F.lit(low), F.lit(high)
        # below the bracket, at its lower end, inside, at its upper end
        where = F.when(at < low, 0).when(at == low, 1).when(at < high, 2).when(at == high, 3)
        part = F.struct(F.lit(i).alias("i"), where.alias("k"), F.when(where == 2, at).alias("v"))
        parts.append(F.when(where.isNotNull(), part))
    kept = values.select(F.explode(F.array_compact(F.array(*parts))).alias("h")).groupBy("h.i", "h.k", "h.v")
    kept = settle(kept.agg(F.count(F.lit(1)).alias("n")))
    sums = {(r["i"], r["k"]): r["n"] for r in kept.groupBy("i", "k").agg(F.sum("n").alias("n")).collect()}
    out, inside = {}, {}
    for (n, rank), ends in brackets.items():
        i = spans.index((n, *ends))
        below, low, within, high = (sums.get((i, k), 0) for k in range(4))
        if below <= rank < below + low:
            out[n, rank] = ends[0]
        elif below + low <= rank < below + low + within:
            inside[n, rank] = (i, rank - below - low)
        elif below + low + within <= rank < below + low + within + high:
            out[n, rank] = ends[1]
    if inside:
        placed = running_offsets(kept.filter("k = 2"), ["v"], "n", "before", by=["i"])
        holds = [
            F.when((F.col("i") == i) & (F.col("before") <= left) & (left < F.col("before") + F.col("n")), j)
            for j, (i, left) in enumerate(inside.values())
        ]
        found = placed.select("v", F.explode(F.array_compact(F.array(*holds))).alias("j")).collect()
        targets = list(inside)
        out |= {targets[r["j"]]: r["v"] for r in found}
    return out


def exact_quantiles(
    df: DataFrame,
    wanted: Mapping[str, list[float]],
    columns: Mapping[str, Column] | None = None,
    buffer_rows: int = BUFFER_ROWS,
    at_most: int | None = None,
    also: Mapping[str, Column] | None = None,
) -> dict:
    """Linearly interpolated quantiles of several columns, NULLs and NaNs left out.

    The result is keyed by (column, probability). ``columns`` may name
    expressions; by default a name is a column of ``df``. ``at_most`` is a
    known bound for the rows of ``df``. ``also`` names further aggregates of
    ``df`` taken in the same pass; they come back under their names.
    """
    also = dict(also or {})
    sources = dict(columns or {n: F.col(n) for n in wanted})
    numeric = df.withColumns({f"q_{n}": _known(c) for n, c in sources.items()})

    if at_most is not None and at_most <= buffer_rows:
        sketched, extra, few = {}, {}, True
    else:
        sketch = [F.approx_count_distinct(f"q_{n}").alias(f"d_{n}") for n in wanted]
        sketched = numeric.agg(
            *_ends(f"q_{n}" for n in wanted), *sketch, *_brackets(wanted),
            *[c.alias(f"also_{n}") for n, c in also.items()],
        ).first()
        extra = {n: sketched[f"also_{n}"] for n in also}
        few = max(sketched[f"d_{n}"] for n in wanted) <= buffer_rows

    if few:
        aggs = [F.percentile(f"q_{n}", [float(p) for p in ps]).alias(n) for n, ps in wanted.items()]
        more = {} if extra else also
        row = numeric.agg(*aggs, *[c.alias(f"also_{n}") for n, c in more.items()]).first()
        extra |= {n: row[f"also_{n}"] for n in more}
        return extra | {
            (n, p): (None if row[n] is None else row[n][i])
            for n, ps in wanted.items()
            for i, p in enumerate(ps)
        }

    ends = {n: sketched[f"q_{n}"] for n in wanted}
    places = {(n, p): (ends[n][0] - 1) * p for n, ps in wanted.items() for p in ps if ends[n][0]}
    brackets = {}
    for (n, p), h in places.items():
        i = 2 * wanted[n].index(p)
        for rank in (math.floor(h), math.ceil(h)):
            brackets.setdefault((n, rank), tuple(sketched[f"b_{n}"][i : i + 2]))
    values = numeric.select(*[F.col(f"q_{n}").alias(n) for n in wanted])
    at = _between_brackets(values, brackets) if brackets else {}
    missed = set(brackets) - set(at)
    if missed:
        at |= values_at_ranks(values, {n: F.col(n) for n in wanted}, missed, ends)
    found = {(n, p): None for n, ps in wanted.items() for p in ps}
    for (n, p), h in places.items():
        low, high = at[n, math.floor(h)], at[n, math.ceil(h)]
        found[n, p] = low + (high - low) * (h - math.floor(h))
    return found | extra


def medians(df: DataFrame, names: list[str], *, approx: bool = False, **options) -> dict:
    """Median of each column; ``approx`` trades exactness for one pass.

    ``also`` works as in ``exact_quantiles``.
    """
    if approx:
        aggs = {n: F.percentile_approx(_known(F.col(n)), 0.5) for n in names}
        aggs |= options.get("also") or {}
        return df.agg(*[c.alias(n) for n, c in aggs.items()]).first().asDict()
    found = exact_quantiles(df, {n: [0.5] for n in names}, **options)
    return {n: found[n, 0.5] for n in names} | {n: found[n] for n in options.get("also") or {}}
