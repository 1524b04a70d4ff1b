"""Code tables of the data model and the lookups over them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values. These must equal the published data model for right results.
# ---------------------------------------------------------------------------
WEATHER_CODES = {"clear": 0, "fog": 1, "rain": 2, "heavy_rain": 3}

LEVELS = [0, 1, 2, 3]

LEVEL_LABELS = {0: "Thông thoáng", 1: "Chậm", 2: "Kẹt nhẹ", 3: "Kẹt nặng"}

LEVEL_COLORS = {0: "#27ae60", 1: "#f39c12", 2: "#e67e22", 3: "#c0392b"}

SUMMARY_NAMES = {0: "thong_thoang", 1: "cham", 2: "ket_nhe", 3: "ket_nang"}

LEVEL_SPEED_RANGES = {0: (45, 70), 1: (20, 45), 2: (8, 20), 3: (2, 8)}

RECOMMENDATIONS = {
    0: "✅ Đường thông thoáng, có thể di chuyển bình thường.",
    1: "🟡 Giao thông chậm. Nên xuất phát sớm 10-15 phút.",
    2: "🟠 Kẹt xe nhẹ! Hãy cân nhắc tuyến đường thay thế.",
    3: "🔴 Kẹt xe nặng! Nên đổi tuyến đường hoặc chờ thêm 30-60 phút.",
}

HOUR_PROFILE = {
    0: 0.05, 1: 0.05, 2: 0.05, 3: 0.05, 4: 0.08, 5: 0.12,
    6: 0.45, 7: 0.85, 8: 0.75, 9: 0.55, 10: 0.35, 11: 0.30,
    12: 0.45, 13: 0.40, 14: 0.30, 15: 0.35, 16: 0.65, 17: 0.90,
    18: 0.85, 19: 0.65, 20: 0.45, 21: 0.35, 22: 0.20, 23: 0.10,
}
SERVING_PROFILE_HOURS = range(6, 22)
SERVING_PROFILE_DEFAULT = 0.10
WEEKEND_FACTOR = 0.65

DEFAULT_WEATHER = "clear"
DEFAULT_VEHICLES = 300
DEFAULT_REQUEST_LANES = 4
SPEED_LIMITS = (0, 120)
VEHICLE_LIMITS = (0, 2000)

HOLIDAYS_2024 = [
    "2024-01-01", "2024-02-08", "2024-02-09", "2024-02-10", "2024-02-11",
    "2024-02-12", "2024-04-18", "2024-04-30", "2024-05-01", "2024-09-02",
]

MODEL_FEATURES = [
    "hour", "day_of_week", "month",
    "is_holiday", "is_weekend", "is_rush_hour",
    "weather_encoded", "vehicle_count",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    "speed_lag1h", "speed_lag24h", "speed_rolling3h", "lanes",
]
# ---------------------------------------------------------------------------


def lookup(code: Column, table: Mapping, default=None) -> Column:
    """Value of ``code`` in a small literal table; ``default`` if absent or NULL."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    found = F.try_element_at(entries, code)
    return found if default is None else F.coalesce(found, F.lit(default))


def level_label(level: Column) -> Column:
    return lookup(level.cast("int"), LEVEL_LABELS)


def level_color(level: Column) -> Column:
    return lookup(level.cast("int"), LEVEL_COLORS)


def level_speed_estimate(level: Column) -> Column:
    """Middle of the level's speed range, in km/h."""
    middles = {k: (lo + hi) / 2 for k, (lo, hi) in LEVEL_SPEED_RANGES.items()}
    return lookup(level.cast("int"), middles)


def level_recommendation(level: Column) -> Column:
    return lookup(level.cast("int"), RECOMMENDATIONS)


def weather_code(weather: Column) -> Column:
    """Ordinal weather code; 0 for an unknown or missing name."""
    return lookup(weather, WEATHER_CODES, default=0)


def is_rainy(weather: Column) -> Column:
    return F.coalesce(weather.contains("rain"), F.lit(False))


def speed_to_level(speed: Column) -> Column:
    """Level from speed; each lower bound is part of the better level."""
    rule = F.when(speed.isNull(), F.lit(None).cast("int"))
    for level in LEVELS[:-1]:
        rule = rule.when(speed >= LEVEL_SPEED_RANGES[level][0], level)
    return rule.otherwise(LEVELS[-1])


def probability_to_level(prob: Column) -> Column:
    """Level from a congestion probability: below 0.2, 0.5, 0.75, or above."""
    rule = F.when(prob.isNull(), F.lit(None).cast("int"))
    for level, upper in enumerate([0.2, 0.5, 0.75]):
        rule = rule.when(prob < upper, level)
    return rule.otherwise(3)


def hour_probability(hour: Column, day_of_week: Column, *, serving: bool = False) -> Column:
    """Congestion probability of an hour, damped on weekends.

    ``serving`` uses the profile known at scoring time: daytime hours only,
    with one default for the rest.
    """
    if serving:
        profile = {h: HOUR_PROFILE[h] for h in SERVING_PROFILE_HOURS}
        base = lookup(hour.cast("int"), profile, default=SERVING_PROFILE_DEFAULT)
    else:
        base = lookup(hour.cast("int"), HOUR_PROFILE)
    return F.when(day_of_week >= 5, base * F.lit(WEEKEND_FACTOR)).otherwise(base)


def fallback_speed(hour: Column, day_of_week: Column) -> Column:
    """Speed assumed for a request that carries none."""
    prob = hour_probability(hour, day_of_week, serving=True)
    return F.when(prob < 0.3, 55.0).when(prob < 0.6, 30.0).otherwise(12.0)
