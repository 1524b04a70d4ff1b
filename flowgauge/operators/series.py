"""Lag and rolling features per key, by rows and by time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.operators.exact_sums import ExactDoubles, value_range
from flowgauge.operators.slices import (
    SLICE_ROWS,
    as_number,
    join_groups,
    names_apart,
    over_preceding_rows,
    slice_hot_groups,
)
from flowgauge.session import settle

ROW_LAGS = {"speed_lag1h": 2, "speed_lag24h": 48}
ROLLING_NAME = "speed_rolling3h"
ROLLING_ROWS = 6
#: Running sums of limbs are kept in this type.
_EXACT = "decimal(38,0)"


def lag_rolling(
    df: DataFrame,
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
    value: str = "avg_speed_kmh",
    *,
    lags: Mapping[str, int] = ROW_LAGS,
    rolling_name: str = ROLLING_NAME,
    rolling_rows: int = ROLLING_ROWS,
    include_current: bool = True,
    fill: float | None = None,
    slice_rows: int = SLICE_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Lags by a number of rows and a mean over the last rows.

    ``include_current=False`` leaves the current row out of the mean.
    ``fill`` replaces the NULLs at the head of each key. ``largest`` is a
    known bound for the rows of any key.
    """
    first, last = (-(rolling_rows - 1), 0) if include_current else (-rolling_rows, -1)

    def columns(w) -> dict[str, Column]:
        out = {name: F.lag(value, n).over(w) for name, n in lags.items()}
        out[rolling_name] = F.avg(value).over(w.rowsBetween(first, last))
        if fill is not None:
            out = {n: F.coalesce(c, F.lit(float(fill))) for n, c in out.items()}
        return out

    back = max([*lags.values(), -first])
    return over_preceding_rows(df, key, [ts, tie], back, [value], columns, slice_rows, largest)


def time_lag_rolling(
    df: DataFrame,
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
    value: str = "avg_speed_kmh",
    *,
    lag_minutes: Mapping[str, int] = {"speed_lag1h": 60, "speed_lag24h": 1440},
    tolerance_minutes: int = 60,
    rolling_minutes: int = 180,
    rolling_name: str = ROLLING_NAME,
    slice_rows: int = SLICE_ROWS,
    frame_rows: int = 200,
) -> DataFrame:
    """Time-true lags and rolling mean, whatever the distance between rows.

    * a lag is the newest known value at least so old, and at most
      ``tolerance_minutes`` older than that;
    * the rolling mean covers the last ``rolling_minutes``, both ends included,
      and ``<rolling_name>_n`` is the number of rows in it.

    A row without a time has no past: NULL lags and mean, and 0 rows.

    A window holds a whole key, and a range frame is summed anew for every
    row. Keys with more than ``slice_rows`` rows, or with more than
    ``frame_rows`` rows within one ``rolling_minutes``, take running sums
    instead: each time looks up the sums at the ends of its frames (see
    ``_running_at``). Both ways add whole numbers (``exact_sums``), so the mean
    is the same to the last bit, also with tiny and huge values, NaN and the
    infinities.
    """
    renamed, back = names_apart(df)
    if back:  # columns that begin with an underscore stand aside meanwhile
        to = {old: new for new, old in back.items()}
        found = time_lag_rolling(
            renamed, to.get(key, key), to.get(ts, ts), to.get(tie, tie), to.get(value, value),
            lag_minutes=lag_minutes, tolerance_minutes=tolerance_minutes, rolling_minutes=rolling_minutes,
            rolling_name=rolling_name, slice_rows=slice_rows, frame_rows=frame_rows,
        )
        return found.withColumnsRenamed(back)

    micro = 60_000_000
    names = [*lag_minutes, rolling_name, f"{rolling_name}_n"]
    whole, df = df, df.filter(F.col(ts).isNotNull())
    kind = whole.schema[value].dataType
    nothing = {n: F.lit(None).cast(kind) for n in lag_minutes}
    nothing |= {rolling_name: F.lit(None).cast("double"), names[-1]: F.lit(0).cast("bigint")}
    timeless = whole.filter(F.col(ts).isNull()).withColumns(nothing)

    number = F.col(value).cast("double")
    spans = df.groupBy(key, F.window(ts, f"{rolling_minutes} minutes").alias("_w")).agg(
        F.count(F.lit(1)).alias("_n"), *value_range(number, ("_low", "_high", "_odd"))
    )
    keys = settle(
        spans.groupBy(key).agg(
            F.sum("_n").alias("_n"), F.max("_n").alias("_dense"),
            F.min("_low").alias("_low"), F.max("_high").alias("_high"), F.bool_or("_odd").alias("_odd"),
        )
    )
    seen = keys.agg(F.min("_low"), F.max("_high"), F.coalesce(F.bool_or("_odd"), F.lit(False))).first()
    exact = ExactDoubles.of_range(*seen, rows=2 * frame_rows)
    hot = keys.filter((F.col("_n") > slice_rows) | (F.col("_dense") > frame_rows))
    hot = settle(hot.select(F.col(key).alias("_hot")))

    def plain(rows: DataFrame) -> DataFrame:
        found = _range_windows(
            exact.split(rows, number), exact,
            key, ts, tie, value, lag_minutes, tolerance_minutes, rolling_minutes, rolling_name,
        )
        return found.select(*df.columns, *names)

    if hot.isEmpty():
        return plain(df).unionByName(timeless)

    is_hot = F.col(key).eqNullSafe(F.col("_hot"))
    cold = plain(df.join(hot, is_hot, "left_anti"))

    rows = df.join(hot, is_hot, "left_semi").withColumn("_t", as_number(df, ts))
    points = exact.split(rows, number).groupBy(key, "_t").agg(
        *[F.sum(F.col(n).cast("decimal(28,0)")).alias(n) for n in exact.names],
        F.count(value).alias("_values"),
        F.count(F.lit(1)).alias("_rows"),
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(tie))).alias("_v"),
    )
    shifts = {"_to": (0, False), "_from": (rolling_minutes * micro, True)}
    shifts |= {f"_lag_{name}": (m * micro, False) for name, m in lag_minutes.items()}
    found = _running_at(settle(points), key, shifts, exact.names, slice_rows)

    n_values = F.col("_to._values") - F.col("_from._values")
    sums = {n: F.col(f"_to.{n}") - F.col(f"_from.{n}") for n in exact.names}
    out = {}
    for name, minutes in lag_minutes.items():
        oldest = F.col("_t") - (minutes + tolerance_minutes) * micro
        last = F.col(f"_lag_{name}")["_last"]
        out[name] = F.when(last["t"] >= oldest, last["v"])
    out[rolling_name] = F.when(n_values > 0, exact.total(sums) / n_values)
    out[f"{rolling_name}_n"] = F.col("_to._rows") - F.col("_from._rows")
    found = found.select(key, "_t", *[c.alias(n) for n, c in out.items()])
    warm = join_groups(rows, found, [key, "_t"]).select(*df.columns, *names)
    return cold.unionByName(warm).unionByName(timeless)


def _range_windows(df, exact, key, ts, tie, value, lag_minutes, tolerance, rolling, rolling_name):
    def minutes(n: int) -> str:
        return f"INTERVAL '{n}' MINUTE"

    def over(agg: str, first: int, last: str) -> Column:
        return F.expr(
            f"{agg} OVER (PARTITION BY `{key}` ORDER BY `{ts}` "
            f"RANGE BETWEEN {minutes(first)} PRECEDING AND {last})"
        )

    out = {
        name: over(
            f"max_by(`{value}`, IF(`{value}` IS NULL, NULL, struct(`{ts}`, `{tie}`)))",
            n + tolerance,
            f"{minutes(n)} PRECEDING",
        )
        for name, n in lag_minutes.items()
    }
    out |= {n: over(f"sum({n})", rolling, "CURRENT ROW") for n in exact.names}
    out["_values"] = over(f"count(`{value}`)", rolling, "CURRENT ROW")
    out[f"{rolling_name}_n"] = over("count(*)", rolling, "CURRENT ROW")
    mean = exact.total({n: F.col(n) for n in exact.names}) / F.col("_values")
    return df.withColumns(out).withColumn(rolling_name, F.when(F.col("_values") > 0, mean))


def _running_at(
    points: DataFrame, key: str, shifts: Mapping[str, tuple[int, bool]], sums: list[str], slice_rows: int
) -> DataFrame:
    """Running totals of ``points`` at shifted times, one struct per shift.

    Every point also asks, for each shift, for the totals up to ``_t - shift``
    (strictly before it if so marked). Points and questions are put in one
    order, cut into slices, summed within slices, and the totals of earlier
    slices are added. ``_last`` is the newest value met, with its time ``t``.
    """
    zero = F.lit(0).cast("bigint")
    data = points.select(
        key, "_t", F.lit(1).alias("_kind"), F.lit(None).cast("bigint").alias("_asked"),
        F.lit(None).cast("string").alias("_shift"), *[F.col(n).cast(_EXACT) for n in sums], "_values", "_rows",
        F.when(F.col("_v").isNotNull(), F.struct(F.col("_t").alias("t"), F.col("_v").alias("v"))).alias("_last"),
    )
    asks = F.array(
        *[
            F.struct(
                F.lit(name).alias("_shift"),
                (F.col("_t") - F.lit(shift).cast("bigint")).alias("at"),
                F.lit(0 if strict else 2).alias("_kind"),
            )
            for name, (shift, strict) in shifts.items()
        ]
    )
    questions = points.select(key, F.col("_t").alias("_asked"), F.explode(asks).alias("a")).select(
        key, F.col("a.at").alias("_t"), "a._kind", "_asked", "a._shift",
        *[zero.cast(_EXACT).alias(n) for n in sums], zero.alias("_values"),
        zero.alias("_rows"), F.lit(None).cast(data.schema["_last"].dataType).alias("_last"),
    )
    sliced = slice_hot_groups(data.unionByName(questions), [key], ["_t"], slice_rows)
    part = sliced.partition
    counts = [*sums, "_values", "_rows"]
    totals = {**{n: F.sum(n) for n in counts}, "_last": F.max("_last")}
    w = Window.partitionBy(*part).orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    answers = sliced.spread(sliced.rows).withColumns({n: a.over(w) for n, a in totals.items()}).filter(
        F.col("_shift").isNotNull()
    )
    if sliced.hot:
        per_slice = sliced.rows.groupBy(*part).agg(*[a.alias(n) for n, a in totals.items()])
        w = Window.partitionBy(key).orderBy(part[-1]).rowsBetween(Window.unboundedPreceding, -1)
        earlier = per_slice.select(*part, *[a.over(w).alias(f"_b{n}") for n, a in totals.items()])
        answers = join_groups(answers, settle(earlier), part).withColumns(
            {
                **{
                    n: F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"_b{n}"), F.lit(0))
                    for n in counts
                },
                "_last": F.greatest("_last", "_b_last"),
            }
        )
    state = F.struct(*counts, "_last")
    per_shift = [F.any_value(F.when(F.col("_shift") == n, state), True).alias(n) for n in shifts]
    return answers.groupBy(key, F.col("_asked").alias("_t")).agg(*per_shift)
