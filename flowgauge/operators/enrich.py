"""Joins that add context to readings, and the time grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.functions import calendar as cal
from flowgauge.functions import codes
from flowgauge.operators.slices import as_number, names_apart, wall_micros
from flowgauge.session import dealt, settle


def join_segments(
    readings: DataFrame,
    segments: DataFrame,
    key: str = "segment_id",
    columns: Sequence[str] = ("district_code", "road_type", "lanes"),
) -> DataFrame:
    """Readings with their segment's columns; orphans drop out.

    No hint: Spark broadcasts the segments if their size allows it, and
    otherwise sort-merges with skewed partitions split at run time.
    """
    return readings.join(segments.select(key, *columns), key)


def calendar_columns(df: DataFrame) -> DataFrame:
    """Weekend, rush hour, weather code and the cyclic encodings."""
    return df.withColumns(
        {
            "is_weekend": cal.is_weekend(F.col("day_of_week")),
            "is_rush_hour": cal.is_rush_hour(F.col("hour")),
            "weather_encoded": codes.weather_code(F.col("weather_condition")),
            **cal.cyclic_columns(),
        }
    )


def derive_date_parts(df: DataFrame, ts: str = "recorded_at") -> DataFrame:
    """Hour, weekday and month written from the time of the reading."""
    return df.withColumns(cal.date_parts(F.col(ts)))


def mark_holidays(
    df: DataFrame, holidays: DataFrame, ts: str = "recorded_at", out: str = "is_holiday"
) -> DataFrame:
    """True where the reading's date is in ``holidays`` (column ``day``)."""
    days = holidays.select(F.col("day").alias("_day"), F.lit(True).alias("_hit")).distinct()
    day = F.col(ts).cast("date")
    keep = [c for c in df.columns if c != out]
    return df.join(days, day == F.col("_day"), "left").select(
        *keep, F.coalesce(F.col("_hit"), F.lit(False)).alias(out)
    )


def hour_profile_columns(df: DataFrame) -> DataFrame:
    """Typical congestion of the reading's hour, its level and fallback speed."""
    hour, dow = F.col("hour"), F.col("day_of_week")
    typical = codes.hour_probability(hour, dow)
    return df.withColumns(
        {
            "typical_prob": typical,
            "typical_level": codes.probability_to_level(typical),
            "fallback_speed": codes.fallback_speed(hour, dow),
        }
    )


#: Length of the smallest time cell; each level's cells are twice as long as those of the level before.
_CELL_MICROS = 60_000_000
#: An event longer than this many of the smallest cells fills half as many cells of its level, or more.
_CELLS_AN_EVENT = 8


def _cell(micros: Column, size: Column) -> Column:
    """Number of the cell of ``size`` microseconds that holds a time."""
    return F.call_function("div", micros - F.pmod(micros, size), size)


def _cell_key(number: Column) -> Column:
    """One number for a cell and its level (63 at most), as a single bigint is looked up fastest."""
    return number * 64 + F.col("_level")


def tag_special_events(
    readings: DataFrame,
    events: DataFrame,
    ts: str = "recorded_at",
    how: str = "inner",
    columns: Sequence[str] = ("event_name", "event_type", "impact_level"),
) -> DataFrame:
    """Each reading with the special events active at its time, ends included.

    An event is filed under the time cells it touches at the level where these
    are nine at most, however long it lasts. A reading looks into one cell of
    each level that some event has, and the exact interval is checked there;
    of an event that touches several cells only the two outer ones hold times
    it doesn't cover. So ten-year events cost nine rows, and the short events
    of a busy day are spread over short cells. The filed events are written in
    the order of the cells, so those of a cell lie together in memory. ``how``
    is inner or left; events that end before they start tag nothing.

    Tagged readings leave the join as they are found and are never shuffled,
    however many events each has. With ``left``, one hit per level is enough
    to tell which readings have a tag at all, and the others are added. There
    the readings are dealt again after they were written: files are read by as
    many tasks as there are cores, which leaves nothing to even out.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    renamed, back = names_apart(readings)
    ts = next((new for new, old in back.items() if old == ts), ts)
    own = renamed.columns
    start, end = as_number(events, "start_time"), as_number(events, "end_time")
    span = F.call_function("div", end - start, F.lit(_CELL_MICROS))
    cells = F.call_function("div", span, F.lit(_CELLS_AN_EVENT))
    level = F.when(cells > 0, F.length(F.bin(cells))).otherwise(0)
    filed = events.filter(F.col("start_time") <= F.col("end_time")).select(
        level.alias("_level"), start.alias("_first"), end.alias("_last"),
        *[F.col(c).alias(f"_tag_{c}") for c in columns],
    )
    size = F.expr(f"shiftleft({_CELL_MICROS}L, _level)")
    cells = F.explode(F.sequence(_cell(F.col("_first"), size), _cell(F.col("_last"), size)))
    filed = filed.withColumn("_cell", cells).withColumn("_cell", _cell_key(F.col("_cell")))
    filed = settle(filed.sort("_cell", "_first"))
    levels = sorted(r["_level"] for r in filed.select("_level").distinct().collect())  # 63 at most

    rows, asking = renamed, renamed
    if how == "left":
        rows = settle(dealt(renamed).withColumn("_row", F.monotonically_increasing_id()))
        asking = dealt(rows)
    probes = F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>"))
    asking = asking.withColumn("_at", as_number(rows, ts)).filter("_at IS NOT NULL").withColumn("_level", probes)
    asking = asking.withColumn("_cell", _cell_key(_cell(F.col("_at"), size))).drop("_level")
    found = asking.join(filed, "_cell").filter(F.col("_at").between(F.col("_first"), F.col("_last")))
    tagged = found.select(*own, *[F.col(f"_tag_{c}").alias(c) for c in columns])
    if how == "left":
        active = asking["_at"].between(filed["_first"], filed["_last"])
        hit = asking.join(filed, (asking["_cell"] == filed["_cell"]) & active, "left_semi").select("_row").distinct()
        kinds = {c: filed.schema[f"_tag_{c}"].dataType for c in columns}
        none = [F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]
        tagged = tagged.union(rows.join(hit, "_row", "left_anti").select(*own, *none))
    return tagged.withColumnsRenamed(back)


def step_micros(step: str) -> int:
    """Length of a step such as ``30 minutes`` in microseconds."""
    number, unit = step.split()
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86_400}
    return int(number) * seconds[unit.rstrip("s")] * 1_000_000


def slot_number(ts: Column, start: Column, step: str) -> Column:
    """0-based number of the slot that holds a time, counted from ``start``."""
    return F.floor((wall_micros(ts) - wall_micros(start)) / F.lit(step_micros(step))).cast("bigint")


def slot_start(number: Column, start: Column, step: str) -> Column:
    """Where a slot begins."""
    seconds = (number * F.lit(step_micros(step) // 1_000_000)).cast("decimal(18,6)")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def slot_count(start: Column, end: Column, step: str) -> Column:
    """Slots that begin at or after ``start`` and end by ``end``."""
    return F.greatest(slot_number(end, start, step), F.lit(0).cast("bigint"))


def slot_grid(keys: DataFrame, start, end, step: str = "30 minutes") -> DataFrame:
    """Every slot from ``start`` up to but not including ``end``, for every key."""
    every = F.expr(f"INTERVAL {step}")
    slots = F.sequence(F.lit(start), F.lit(end) - every, every)
    return keys.withColumn("slot", F.explode(slots))


def slot_values(
    readings: DataFrame, start, end, step: str, key: str, ts: str, value: str
) -> DataFrame:
    """(key, number, n_readings, mean_value) of the slots that hold readings.

    Readings are combined per (key, slot) before the shuffle, so a hot key is
    spread over its slots.
    """
    start, end = F.lit(start), F.lit(end)
    number = slot_number(F.col(ts), start, step)
    return (
        readings.filter((F.col(ts) >= start) & (number < slot_count(start, end, step)))
        .groupBy(key, number.alias("number"))
        .agg(F.count(F.lit(1)).alias("n_readings"), F.avg(value).alias("mean_value"))
    )


def densify(
    readings: DataFrame,
    keys: DataFrame,
    start,
    end,
    step: str = "30 minutes",
    key: str = "segment_id",
    ts: str = "recorded_at",
    value: str = "avg_speed_kmh",
) -> DataFrame:
    """The grid with the readings of each slot: their number and mean value."""
    seen = slot_values(readings, start, end, step, key, ts, value)
    seen = seen.withColumn("slot", slot_start(F.col("number"), F.lit(start), step)).drop("number")
    return (
        slot_grid(keys, start, end, step)
        .join(seen, [key, "slot"], "left")
        .withColumn("n_readings", F.coalesce(F.col("n_readings"), F.lit(0).cast("bigint")))
    )


def slot_gaps(
    readings: DataFrame,
    keys: DataFrame,
    start,
    end,
    step: str = "30 minutes",
    key: str = "segment_id",
    ts: str = "recorded_at",
    value: str = "avg_speed_kmh",
) -> DataFrame:
    """Per key: slots, observed and missing slots, first and last missing slot.

    Only observed slots are looked at, of which a key has as many as the grid
    at most. In order they are numbered like the grid up to the first gap, and
    from the end down to the last one.
    """
    start, end = F.lit(start), F.lit(end)
    n = slot_count(start, end, step)
    seen = slot_values(readings, start, end, step, key, ts, value)
    up = Window.partitionBy(key).orderBy("number")
    placed = seen.select(
        key,
        "number",
        (F.row_number().over(up) - 1).cast("bigint").alias("_nth"),
        F.count(F.lit(1)).over(Window.partitionBy(key)).alias("_all"),
    )
    from_end = n - F.col("_all") + F.col("_nth")  # its number if no slot after it were missing
    observed = placed.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_observed"),
        F.min(F.when(F.col("number") > F.col("_nth"), F.col("_nth"))).alias("_first"),
        F.max(F.when(F.col("number") < from_end, from_end)).alias("_last"),
    )
    missing = n - F.coalesce(F.col("n_observed"), F.lit(0))
    first = F.coalesce("_first", "n_observed", F.lit(0))
    last = F.coalesce(F.col("_last"), n - 1 - F.coalesce("n_observed", F.lit(0)))
    return keys.join(observed, key, "left").select(
        key,
        n.alias("n_slots"),
        F.coalesce("n_observed", F.lit(0)).cast("bigint").alias("n_observed"),
        missing.cast("bigint").alias("n_missing"),
        F.when(missing > 0, slot_start(first, start, step)).alias("first_missing"),
        F.when(missing > 0, slot_start(last, start, step)).alias("last_missing"),
    )
