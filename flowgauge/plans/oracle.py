"""The same queries as SQL text, for comparison in another engine."""

from __future__ import annotations

from flowgauge.plans.adapters import SPECIAL_EVENTS

# ---------------------------------------------------------------------------
# Fixed values, written out here a second time: the SQL must not take them from
# the module that it is compared with.
# ---------------------------------------------------------------------------
WEATHER = {"clear": 0, "fog": 1, "rain": 2, "heavy_rain": 3}
LABELS = {0: "Thông thoáng", 1: "Chậm", 2: "Kẹt nhẹ", 3: "Kẹt nặng"}
COLORS = {0: "#27ae60", 1: "#f39c12", 2: "#e67e22", 3: "#c0392b"}
SUMMARY = {0: "thong_thoang", 1: "cham", 2: "ket_nhe", 3: "ket_nang"}
ADVICE = {
    0: "✅ Đường thông thoáng, có thể di chuyển bình thường.",
    1: "🟡 Giao thông chậm. Nên xuất phát sớm 10-15 phút.",
    2: "🟠 Kẹt xe nhẹ! Hãy cân nhắc tuyến đường thay thế.",
    3: "🔴 Kẹt xe nặng! Nên đổi tuyến đường hoặc chờ thêm 30-60 phút.",
}
HOURS = {
    0: 0.05, 1: 0.05, 2: 0.05, 3: 0.05, 4: 0.08, 5: 0.12,
    6: 0.45, 7: 0.85, 8: 0.75, 9: 0.55, 10: 0.35, 11: 0.30,
    12: 0.45, 13: 0.40, 14: 0.30, 15: 0.35, 16: 0.65, 17: 0.90,
    18: 0.85, 19: 0.65, 20: 0.45, 21: 0.35, 22: 0.20, 23: 0.10,
}
HOLIDAYS = [
    "2024-01-01", "2024-02-08", "2024-02-09", "2024-02-10", "2024-02-11",
    "2024-02-12", "2024-04-18", "2024-04-30", "2024-05-01", "2024-09-02",
]
# ---------------------------------------------------------------------------

READINGS = """
readings AS (
  SELECT event_id AS id, user_id AS segment_id, ts AS recorded_at,
         CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) - 1 AS INT) AS day_of_week,
         CAST(month(ts) AS INT) AS month,
         CAST(ts AS DATE) IN (DATE '2024-01-01', DATE '2024-02-08') AS is_holiday,
         CASE event_type WHEN 'view' THEN 'clear' WHEN 'click' THEN 'rain'
              WHEN 'purchase' THEN 'heavy_rain' WHEN 'signup' THEN 'fog' END AS weather_condition,
         CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS avg_speed_kmh,
         CASE WHEN event_id % 23 = 0 THEN NULL
              ELSE CAST(json_extract_string(props, '$.k') AS INT) END AS vehicle_count,
         CASE WHEN value >= 45 THEN 0 WHEN value >= 20 THEN 1
              WHEN value >= 8 THEN 2 ELSE 3 END AS congestion_level
  FROM events)"""

SEGMENTS = """
segments AS (
  SELECT c_custkey AS segment_id, CAST(c_nationkey AS INT) AS district_code,
         c_name AS street_name, c_mktsegment AS road_type,
         CAST(2 + 2 * (c_custkey % 4) AS INT) AS lanes
  FROM customer)"""

DISTRICTS = """
districts AS (
  SELECT n_nationkey AS code, n_name AS name, n_regionkey AS region FROM nation)"""

PAIRS = "pred AS (SELECT quality AS label, toxic AS prediction FROM labels)"


def case(code: str, table: dict) -> str:
    def text(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    whens = " ".join(f"WHEN {text(k)} THEN {text(v)}" for k, v in table.items())
    return f"CASE {code} {whens} END"


STATUS = f"""
newest AS (
  SELECT * FROM (
    SELECT segment_id, avg_speed_kmh, vehicle_count, congestion_level, weather_condition,
           recorded_at,
           row_number() OVER (PARTITION BY segment_id ORDER BY recorded_at DESC, id DESC) AS rn
    FROM readings) WHERE rn = 1),
status AS (
  SELECT s.*, n.avg_speed_kmh, n.vehicle_count, n.congestion_level, n.weather_condition,
         n.recorded_at,
         {case("n.congestion_level", LABELS)} AS status_label,
         {case("n.congestion_level", COLORS)} AS status_color
  FROM segments s LEFT JOIN newest n USING (segment_id))"""

JOINED = """
joined AS (
  SELECT r.*, s.district_code, s.road_type, s.lanes
  FROM readings r JOIN segments s USING (segment_id))"""


def filled(source: str, name: str, extra: str = "") -> str:
    return f"""
{name} AS (
  SELECT id, segment_id, recorded_at, hour, day_of_week, month, is_holiday,
         coalesce(weather_condition, 'clear') AS weather_condition,
         coalesce(avg_speed_kmh,
                  (SELECT quantile_cont(avg_speed_kmh, 0.5) FROM {source})) AS avg_speed_kmh,
         coalesce(CAST(vehicle_count AS DOUBLE),
                  (SELECT quantile_cont(CAST(vehicle_count AS DOUBLE), 0.5) FROM {source}))
           AS vehicle_count,
         congestion_level{extra}
  FROM {source})"""


CLEAN = (
    filled("joined", "full_rows", ", district_code, road_type, lanes")
    + """,
clean AS (
  SELECT * FROM full_rows
  WHERE avg_speed_kmh BETWEEN 0 AND 120 AND vehicle_count BETWEEN 0 AND 2000)"""
)


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


R = with_(READINGS)
RS = with_(READINGS, SEGMENTS)
RSS = with_(READINGS, SEGMENTS, STATUS)
RSJ = with_(READINGS, SEGMENTS, JOINED)
RSC = with_(READINGS, SEGMENTS, JOINED, CLEAN)


def r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) + 0.0::DOUBLE AS {name}"


def cyclic() -> str:
    out = []
    for name, column, period in (("hour", "hour", 24), ("dow", "day_of_week", 7), ("month", "month", 12)):
        for fn in ("sin", "cos"):
            out.append(r6(f"{fn}(2 * pi() * {column} / {period})", f"{name}_{fn}"))
    return ", ".join(out)


CALENDAR = f"""
  CAST(day_of_week >= 5 AS INT) AS is_weekend,
  CAST(hour BETWEEN 6 AND 8 OR hour BETWEEN 16 AND 19 AS INT) AS is_rush_hour,
  coalesce({case("weather_condition", WEATHER)}, 0) AS weather_encoded,
  {cyclic()}"""


def lags(fill: str = "", first: str = "5 PRECEDING", last: str = "CURRENT ROW") -> str:
    w = "OVER (PARTITION BY segment_id ORDER BY recorded_at, id"
    columns = [
        (f"lag(avg_speed_kmh, 2) {w})", "speed_lag1h"),
        (f"lag(avg_speed_kmh, 48) {w})", "speed_lag24h"),
        (f"avg(avg_speed_kmh) {w} ROWS BETWEEN {first} AND {last})", "speed_rolling3h"),
    ]
    return ", ".join(r6(f"coalesce({c}, {fill})" if fill else c, n) for c, n in columns)


CLEAN_MEDIAN = "(SELECT quantile_cont(avg_speed_kmh, 0.5) FROM clean)"
ROAD_TYPES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
ROAD_DUMMIES = ", ".join(f"CAST(road_type = '{t}' AS INT) AS road_{t}" for t in ROAD_TYPES[1:])
DISTRICT_DUMMIES = ", ".join(f"CAST(district_code = {d} AS INT) AS dist_{d}" for d in range(1, 25))

HOTSPOT_ORDER = "congestion_level DESC NULLS FIRST, avg_speed_kmh ASC NULLS LAST, segment_id"


def hotspots(limit: int, where: str = "") -> str:
    return f"""{RSS}
SELECT *, CAST(row_number() OVER (ORDER BY {HOTSPOT_ORDER}) AS INT) AS rank
FROM (SELECT * FROM status {where} ORDER BY {HOTSPOT_ORDER} LIMIT {limit})"""


def summary(where: str = "") -> str:
    counts = ", ".join(
        f"count(*) FILTER (coalesce(congestion_level, 0) = {k}) AS {n}"
        for k, n in SUMMARY.items()
    )
    return f"""{RSS}
SELECT {counts}, count(*) AS total_segments,
       count(*) FILTER (congestion_level IS NULL) AS n_no_data
FROM status {where}"""


HOURLY = """
hourly AS (
  SELECT hour, day_of_week,
         CAST(avg(CAST(congestion_level AS DOUBLE)) AS DECIMAL(3,2)) AS avg_congestion,
         CAST(avg(avg_speed_kmh) AS DECIMAL(5,2)) AS avg_speed,
         count(*) AS record_count
  FROM readings GROUP BY ALL)"""

HEATMAP_COLUMNS = ", ".join(
    f"CAST(avg(avg_congestion) FILTER (hour = {h}) AS DECIMAL(7,6)) AS h{h:02d}" for h in range(24)
)

EVENT_ROWS = ", ".join(
    f"('{n}', '{t}', TIMESTAMP '{a}', TIMESTAMP '{b}', {i})" for n, t, a, b, i in SPECIAL_EVENTS
)
HOLIDAY_LIST = ", ".join(f"DATE '{d}'" for d in HOLIDAYS)

GRID = """
grid AS (
  SELECT segment_id, unnest(generate_series(
           TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:30:00', INTERVAL 30 MINUTE)) AS slot
  FROM (SELECT DISTINCT segment_id FROM readings)),
seen AS (
  SELECT segment_id, time_bucket(INTERVAL 30 MINUTE, recorded_at) AS slot,
         count(*) AS n, avg(avg_speed_kmh) AS mean_value
  FROM readings GROUP BY ALL),
dense AS (
  SELECT g.segment_id, g.slot, coalesce(n, 0) AS n_readings, mean_value
  FROM grid g LEFT JOIN seen s ON g.segment_id = s.segment_id AND g.slot = s.slot)"""

SPEED_ESTIMATES = {0: "57.5::DOUBLE", 1: "32.5::DOUBLE", 2: "14.0::DOUBLE", 3: "5.0::DOUBLE"}
SPEED_CASE = "CASE level " + " ".join(f"WHEN {k} THEN {v}" for k, v in SPEED_ESTIMATES.items()) + " END"

PROFILE = "CASE hour " + " ".join(f"WHEN {h} THEN {p}::DOUBLE" for h, p in HOURS.items()) + " END"
WEEKEND = "CASE WHEN day_of_week >= 5 THEN {0} * 0.65::DOUBLE ELSE {0} END"
SERVING = f"(CASE WHEN hour BETWEEN 6 AND 21 THEN {PROFILE} ELSE 0.1::DOUBLE END)"
FALLBACK = (
    "CASE WHEN s < 0.3::DOUBLE THEN 55.0::DOUBLE WHEN s < 0.6::DOUBLE THEN 30.0::DOUBLE "
    "ELSE 12.0::DOUBLE END"
)
LEVEL_RULE = (
    "CASE WHEN {0} < 0.2::DOUBLE THEN 0 WHEN {0} < 0.5::DOUBLE THEN 1 "
    "WHEN {0} < 0.75::DOUBLE THEN 2 WHEN {0} IS NOT NULL THEN 3 END"
)

SCALED = ["hour", "day_of_week", "month", "avg_speed_kmh", "vehicle_count"]


def zscore(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return r6(
        f"({x} - (SELECT avg({x}) FROM clean)) / "
        f"(SELECT coalesce(nullif(stddev_pop({x}), 0), 1) FROM clean)",
        f"{c}_z",
    )


CELLS = """
cells AS (
  SELECT a.l AS label, b.l AS prediction,
         (SELECT count(*) FROM pred WHERE pred.label = a.l AND pred.prediction = b.l) AS n
  FROM range(4) a(l), range(4) b(l))"""

SCORES = """
sides AS (
  SELECT l AS label,
         coalesce((SELECT sum(n) FROM cells WHERE label = l), 0)::DOUBLE AS support,
         coalesce((SELECT sum(n) FROM cells WHERE prediction = l), 0)::DOUBLE AS guessed,
         coalesce((SELECT sum(n) FROM cells WHERE prediction = l AND label = l), 0)::DOUBLE AS hits
  FROM range(4) t(l)),
scores AS (
  SELECT label, support, hits,
         CASE WHEN guessed = 0 THEN 0 ELSE hits / guessed END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
         2 * hits / (support + guessed) AS f1
  FROM sides WHERE support + guessed > 0)"""

CUTOFF = "(SELECT quantile_cont(epoch_us(recorded_at), 1 - 0.2::DOUBLE) FROM readings)"

FOLDS = f"""{R},
placed AS (
  SELECT id, congestion_level,
         row_number() OVER (ORDER BY segment_id, recorded_at, id) - 1 AS g,
         row_number() OVER (PARTITION BY congestion_level
                            ORDER BY segment_id, recorded_at, id) - 1 AS p
  FROM readings),
classes AS (
  SELECT congestion_level, count(*) AS n, min(g) AS first FROM placed GROUP BY 1),
starts AS (
  SELECT congestion_level, n, coalesce(sum(n) OVER (
           ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM classes),
shares AS (
  SELECT congestion_level, f, (SELECT count(*) FROM range(CAST(s AS BIGINT), CAST(s + n AS BIGINT)) j(x)
                               WHERE x % 5 = f) AS share
  FROM starts, range(5) t(f)),
ends AS (
  SELECT congestion_level, f, sum(share) OVER (PARTITION BY congestion_level ORDER BY f) AS e
  FROM shares)
SELECT id, placed.congestion_level, CAST(min(f) AS INT) AS fold
FROM placed JOIN ends ON placed.congestion_level = ends.congestion_level AND p < e
GROUP BY ALL"""

READING_CHECKS = {
    "hour": "hour NOT BETWEEN 0 AND 23",
    "day_of_week": "day_of_week NOT BETWEEN 0 AND 6",
    "month": "month NOT BETWEEN 1 AND 12",
    "avg_speed_kmh": "avg_speed_kmh NOT BETWEEN 0 AND 120",
    "vehicle_count": "vehicle_count NOT BETWEEN 0 AND 50",
}
REQUEST_MESSAGES = [
    ("segment_id IS NULL", "segment_id is required"),
    ("hour IS NULL", "hour is required"),
    ("day_of_week IS NULL", "day_of_week is required"),
    ("month IS NULL", "month is required"),
    ("hour NOT BETWEEN 0 AND 23", "hour must be between 0 and 23"),
    ("day_of_week NOT BETWEEN 0 AND 6", "day_of_week must be between 0 and 6"),
    ("month NOT BETWEEN 1 AND 12", "month must be between 1 and 12"),
    ("avg_speed_kmh NOT BETWEEN 0 AND 120", "avg_speed_kmh must be between 0 and 120"),
    ("vehicle_count < 0", "vehicle_count must be at least 0"),
    ("id % 12 NOT BETWEEN 1 AND 10", "lanes must be between 1 and 10"),
]

CHECKED = f"""
checked AS (
  SELECT id, concat_ws('; ', {", ".join(f"CASE WHEN {c} THEN '{m}' END" for c, m in REQUEST_MESSAGES)})
           AS errors
  FROM readings)"""


def counted(checks: dict[str, str]) -> str:
    return R + " UNION ALL ".join(
        f" SELECT '{n}' AS check_name, count(*) AS n_violations FROM readings WHERE {c}"
        for n, c in checks.items()
    )


CLOSED_HOURS = f"""
windows AS (
  SELECT time_bucket(INTERVAL 1 HOUR, recorded_at) AS window_start,
         time_bucket(INTERVAL 1 HOUR, recorded_at) + INTERVAL 1 HOUR AS window_end,
         avg(CAST(congestion_level AS DOUBLE)) AS c, avg(avg_speed_kmh) AS s, count(*) AS record_count
  FROM readings GROUP BY ALL)
SELECT window_start, window_end, {r6("c", "avg_congestion")}, {r6("s", "avg_speed")}, record_count
FROM windows
WHERE window_end <= (SELECT max(recorded_at) FROM readings) - INTERVAL 10 MINUTE"""

ORACLE: dict[str, str] = {
    "segments_with_district": f"""{with_(SEGMENTS, DISTRICTS)}
SELECT s.*, d.name AS district_name FROM segments s JOIN districts d ON s.district_code = d.code""",
    "segments_of_district": f"""{with_(SEGMENTS, DISTRICTS)}
SELECT s.*, d.name AS district_name FROM segments s JOIN districts d ON s.district_code = d.code
WHERE s.district_code = 7""",
    "segment_lookup": f"{with_(SEGMENTS)} SELECT * FROM segments WHERE segment_id = 42",
    "districts_sorted": f"{with_(DISTRICTS)} SELECT * FROM districts ORDER BY code",
    "segments_located": f"""{RSS}
SELECT * FROM status WHERE avg_speed_kmh <> 0 AND vehicle_count <> 0""",
    "current_status": f"{RSS} SELECT * FROM status",
    "realtime_all": f"""{RSS} SELECT * FROM status
ORDER BY congestion_level DESC NULLS FIRST, district_code, segment_id""",
    "realtime_district": f"""{RSS} SELECT * FROM status WHERE district_code = 7
ORDER BY congestion_level DESC NULLS FIRST, district_code, segment_id""",
    "hotspots": hotspots(10),
    "hotspots_observed": hotspots(50, "WHERE congestion_level IS NOT NULL"),
    "level_summary": summary(),
    "level_summary_district": summary("WHERE district_code = 7"),
    "history_one_key": f"""{R}
SELECT recorded_at, hour, avg_speed_kmh, vehicle_count, congestion_level, weather_condition
FROM readings
WHERE segment_id = 8 AND recorded_at >= TIMESTAMP '2024-01-31' - INTERVAL 168 HOUR
ORDER BY recorded_at DESC, id DESC LIMIT 200""",
    "hourly_stats": f"{R},{HOURLY} SELECT * FROM hourly",
    "hourly_stats_one_day": f"{R},{HOURLY} SELECT * FROM hourly WHERE day_of_week = 2",
    "heatmap_pivot": f"{R},{HOURLY} SELECT day_of_week, {HEATMAP_COLUMNS} FROM hourly GROUP BY 1",
    "row_counts": f"""{with_(READINGS, SEGMENTS, DISTRICTS)}
SELECT 'readings' AS table_name, count(*) AS n_rows FROM readings
UNION ALL SELECT 'segments', count(*) FROM segments
UNION ALL SELECT 'districts', count(*) FROM districts""",
    "global_medians": f"""{R},
m AS (SELECT quantile_cont(avg_speed_kmh, 0.5) AS s,
             quantile_cont(CAST(vehicle_count AS DOUBLE), 0.5) AS v FROM readings)
SELECT s AS median_speed, v AS median_vehicles,
       count(*) FILTER (avg_speed_kmh < s) AS n_slower,
       count(*) FILTER (vehicle_count < v) AS n_fewer
FROM readings, m GROUP BY s, v""",
    "clean_readings": f"{RSC} SELECT * FROM clean",
    "fill_missing": f"{R},{filled('readings', 'full_rows')} SELECT * FROM full_rows",
    "outliers_removed": f"""{RSC}
SELECT (SELECT count(*) FROM full_rows) AS n_before, count(*) AS n_kept,
       (SELECT count(*) FROM full_rows) - count(*) AS n_removed FROM clean""",
    "join_dim": f"{RSJ} SELECT * FROM joined",
    "holiday_lookup": f"""{R}
SELECT id, recorded_at, CAST(recorded_at AS DATE) IN ({HOLIDAY_LIST}) AS is_holiday FROM readings""",
    "event_tagging": f"""{R},
happenings(event_name, event_type, start_time, end_time, impact_level) AS (VALUES {EVENT_ROWS})
SELECT id, segment_id, recorded_at, event_name, event_type, impact_level
FROM readings JOIN happenings ON recorded_at BETWEEN start_time AND end_time""",
    "event_tagging_long": f"""{R},
happenings AS (
  SELECT 'e' || id AS event_name, recorded_at AS start_time, recorded_at + to_hours(id % 401) AS end_time
  FROM readings WHERE id % 331 = 0)
SELECT id, recorded_at, event_name
FROM readings LEFT JOIN happenings ON recorded_at BETWEEN start_time AND end_time""",
    "slot_gaps": f"""{R},{GRID}
SELECT segment_id, count(*) AS n_slots,
       count(*) FILTER (n_readings > 0) AS n_observed, count(*) FILTER (n_readings = 0) AS n_missing,
       min(slot) FILTER (n_readings = 0) AS first_missing,
       max(slot) FILTER (n_readings = 0) AS last_missing
FROM dense GROUP BY 1""",
    "slot_gaps_offset": f"""{R},
grid AS (
  SELECT segment_id, unnest(generate_series(TIMESTAMP '2024-01-03 00:10:00', TIMESTAMP '2024-01-09 06:10:00',
                                            INTERVAL 30 MINUTE)) AS slot
  FROM (SELECT DISTINCT segment_id FROM readings)),
dense AS (
  SELECT g.segment_id, slot, count(r.id) AS n_readings
  FROM grid g LEFT JOIN readings r ON r.segment_id = g.segment_id
       AND recorded_at >= slot AND recorded_at < slot + INTERVAL 30 MINUTE
  GROUP BY 1, 2)
SELECT segment_id, count(*) AS n_slots,
       count(*) FILTER (n_readings > 0) AS n_observed, count(*) FILTER (n_readings = 0) AS n_missing,
       min(slot) FILTER (n_readings = 0) AS first_missing,
       max(slot) FILTER (n_readings = 0) AS last_missing
FROM dense GROUP BY 1""",
    "slot_grid_daily": f"""{R},{GRID}
SELECT segment_id, CAST(slot AS DATE) AS day, count(*) AS n_slots,
       CAST(sum(n_readings) AS BIGINT) AS n_readings, {r6("avg(mean_value)", "mean_value")}
FROM dense GROUP BY 1, 2""",
    "calendar_features": f"""{R}
SELECT id, {CALENDAR}, CAST(is_holiday AS INT) AS is_holiday,
       coalesce(contains(weather_condition, 'rain'), FALSE) AS is_rainy
FROM readings""",
    "date_parts": f"{R} SELECT id, recorded_at, hour, day_of_week, month FROM readings",
    "speed_level": f"""{R},
levels AS (
  SELECT id, CASE WHEN avg_speed_kmh IS NULL THEN NULL ELSE congestion_level END AS level FROM readings)
SELECT id, level, {case("level", LABELS)} AS label,
       {case("level", COLORS)} AS color, {SPEED_CASE} AS estimated_speed_kmh,
       {case("level", ADVICE)} AS recommendation
FROM levels""",
    "hour_profile": f"""{R},
probs AS (
  SELECT id, {WEEKEND.format(PROFILE)} AS t, {WEEKEND.format(SERVING)} AS s FROM readings)
SELECT id, {r6("t", "typical_prob")}, {LEVEL_RULE.format("t")} AS typical_level,
       {FALLBACK} AS fallback_speed
FROM probs""",
    "prob_level": f"""{R},
probs AS (
  SELECT id, CASE WHEN avg_speed_kmh IS NOT NULL
                  THEN greatest(0::DOUBLE, least(1::DOUBLE, avg_speed_kmh / 100::DOUBLE)) END AS p
  FROM readings)
SELECT id, {r6("p", "prob")}, {LEVEL_RULE.format("p")} AS level FROM probs""",
    "lag_rolling": f"{RSC} SELECT id, segment_id, {lags()} FROM clean",
    "lag_rolling_filled": f"""{RSC}
SELECT id, segment_id, {lags(CLEAN_MEDIAN, "6 PRECEDING", "1 PRECEDING")} FROM clean""",
    "rolling_time_range": f"""{R},
lagged AS (
  SELECT id, segment_id,
         (SELECT arg_max(p.avg_speed_kmh, (p.recorded_at, p.id)) FROM readings p
          WHERE p.segment_id = r.segment_id
            AND p.recorded_at BETWEEN r.recorded_at - INTERVAL 120 MINUTE
                                  AND r.recorded_at - INTERVAL 60 MINUTE) AS l1,
         (SELECT arg_max(p.avg_speed_kmh, (p.recorded_at, p.id)) FROM readings p
          WHERE p.segment_id = r.segment_id
            AND p.recorded_at BETWEEN r.recorded_at - INTERVAL 1500 MINUTE
                                  AND r.recorded_at - INTERVAL 1440 MINUTE) AS l24,
         avg(avg_speed_kmh) OVER w AS a, count(*) OVER w AS n
  FROM readings r
  WINDOW w AS (PARTITION BY segment_id ORDER BY recorded_at
               RANGE BETWEEN INTERVAL 3 HOUR PRECEDING AND CURRENT ROW))
SELECT id, segment_id, {r6("l1", "speed_lag1h")}, {r6("l24", "speed_lag24h")},
       {r6("a", "speed_rolling3h")}, n AS speed_rolling3h_n
FROM lagged""",
    "one_hot_road": f"{with_(SEGMENTS)} SELECT segment_id, {ROAD_DUMMIES} FROM segments",
    "one_hot_street": f"""{with_(SEGMENTS)}
SELECT segment_id, (SELECT count(DISTINCT street_name) FROM segments) - 1 AS n_places,
       dense_rank() OVER (ORDER BY street_name) - 1 AS place
FROM segments""",
    "feature_frame": f"""{RSC}
SELECT id, segment_id, recorded_at, hour, day_of_week, month,
       CAST(is_holiday AS INT) AS is_holiday, weather_condition,
       {r6("avg_speed_kmh", "avg_speed_kmh")}, {r6("vehicle_count", "vehicle_count")},
       congestion_level, district_code, road_type, lanes,
       {CALENDAR}, {lags(CLEAN_MEDIAN)}, {DISTRICT_DUMMIES}, {ROAD_DUMMIES}
FROM clean""",
    "split_positional": f"""{RSC}
SELECT id, segment_id, recorded_at,
       CASE WHEN row_number() OVER (ORDER BY segment_id, recorded_at, id)
                 <= floor((SELECT count(*) FROM clean) * (1 - 0.2::DOUBLE))
            THEN 'TRAIN' ELSE 'TEST' END AS set
FROM clean""",
    "split_time": f"""{R}
SELECT id, recorded_at,
       CASE WHEN epoch_us(recorded_at) < {CUTOFF} THEN 'TRAIN' ELSE 'TEST' END AS set
FROM readings""",
    "global_position": f"""{R}
SELECT id, segment_id, recorded_at,
       row_number() OVER (ORDER BY segment_id, recorded_at, id) - 1 AS position
FROM readings""",
    "folds": FOLDS,
    "class_distribution": f"""{R},
tagged AS (
  SELECT congestion_level,
         CASE WHEN epoch_us(recorded_at) < {CUTOFF} THEN 'TRAIN' ELSE 'TEST' END AS set
  FROM readings),
counts AS (SELECT set, congestion_level, count(*) AS n FROM tagged GROUP BY ALL),
shares AS (SELECT *, n / (sum(n) OVER (PARTITION BY set))::DOUBLE AS s FROM counts)
SELECT set, congestion_level, {case("congestion_level", LABELS)} AS label_text, n,
       {r6("s", "share")}, {r6("s * 100", "percent")}
FROM shares""",
    "class_weights": f"""{R},
counts AS (SELECT congestion_level, count(*) AS n FROM readings GROUP BY 1)
SELECT congestion_level, n,
       {r6("(SELECT sum(n) FROM counts)::DOUBLE / ((SELECT count(*) FROM counts) * n)", "weight")}
FROM counts""",
    "scaling_parameters": RSC + " UNION ALL ".join(
        f"""
SELECT '{c}' AS feature, {r6(f"avg(CAST({c} AS DOUBLE))", "mean")},
       {r6(f"stddev_pop(CAST({c} AS DOUBLE))", "std")} FROM clean"""
        for c in SCALED
    ),
    "zscore": f"{RSC} SELECT id, {', '.join(zscore(c) for c in SCALED)} FROM clean",
    "confusion": f"""{with_(PAIRS, CELLS)}
SELECT CAST(label AS INT) AS label, CAST(prediction AS INT) AS prediction, n FROM cells""",
    "class_report": f"""{with_(PAIRS, CELLS, SCORES)},
report AS (
  SELECT CAST(label AS VARCHAR) AS class, precision, recall, f1, support FROM scores
  UNION ALL
  SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support),
         sum(hits) / sum(support), sum(support) FROM scores
  UNION ALL
  SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM scores
  UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support),
         sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
  FROM scores)
SELECT class, {r6("precision", "precision")}, {r6("recall", "recall")}, {r6("f1", "f1")},
       CAST(support AS BIGINT) AS support
FROM report""",
    "f1_scores": f"""{with_(PAIRS, CELLS, SCORES)}
SELECT {r6("sum(hits) / sum(support)", "accuracy")},
       {r6("sum(f1 * support) / sum(support)", "f1_weighted")},
       {r6("avg(f1)", "f1_macro")}, CAST(sum(support) AS BIGINT) AS n
FROM scores""",
    "dq_ranges": counted(READING_CHECKS),
    "dq_nulls": counted(
        {
            n: f"{n} IS NULL"
            for n in (
                "id", "segment_id", "recorded_at", "weather_condition", "avg_speed_kmh", "vehicle_count",
            )
        }
    ),
    "dq_unique": """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY ALL HAVING count(*) > 1""",
    "dq_fk": f"""{with_(READINGS, DISTRICTS)}
SELECT vehicle_count, count(*) AS n FROM readings
WHERE vehicle_count IS NOT NULL AND vehicle_count NOT IN (SELECT code FROM districts) GROUP BY 1""",
    "dq_fk_rows": f"""{with_(READINGS, DISTRICTS)}
SELECT id, vehicle_count FROM readings
WHERE vehicle_count IS NOT NULL AND vehicle_count NOT IN (SELECT code FROM districts)""",
    "dq_duplicates": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_partkey, l_suppkey) AS rn FROM lineitem)
WHERE rn = 1""",
    "column_defaults": f"""{R}
SELECT id, coalesce(weather_condition, 'clear') AS weather_condition,
       coalesce(vehicle_count, 300) AS vehicle_count FROM readings""",
    "insert_if_absent": f"""{RS}
SELECT * FROM segments WHERE segment_id NOT IN (SELECT segment_id FROM readings)""",
    "validate_requests": f"{R},{CHECKED} SELECT id, errors = '' AS valid, errors FROM checked",
    "prediction_quarantine": f"""{R},{CHECKED}
SELECT r.id, r.segment_id, r.recorded_at AS target_datetime, errors AS error,
       r.segment_id AS asked_segment, r.hour AS asked_hour, CAST(r.id % 12 AS INT) AS asked_lanes
FROM checked c JOIN readings r ON r.id = c.id WHERE errors <> ''""",
    "fallback_speed": f"""{R},
probs AS (SELECT id, {WEEKEND.format(SERVING)} AS s FROM readings)
SELECT id, {FALLBACK} AS fallback_speed FROM probs""",
    "request_features": f"""{R},
speeds AS (
  SELECT *, {WEEKEND.format(SERVING)} AS s FROM readings),
filled AS (
  SELECT *, coalesce(avg_speed_kmh, {FALLBACK}) AS speed FROM speeds)
SELECT id, speed AS avg_speed_kmh, speed AS speed_lag1h, speed AS speed_lag24h,
       speed AS speed_rolling3h, coalesce(nullif(vehicle_count, 0), 300) AS vehicle_count,
       CAST(is_holiday AS INT) AS is_holiday,
       coalesce({case("weather_condition", WEATHER)}, 0) AS weather_encoded
FROM filled""",
    "score_isolation": f"""{R},{CHECKED}
SELECT id, nullif(errors, '') AS error, errors = '' AS has_level, errors = '' AS level_fits,
       errors = '' AS odds_fit
FROM checked""",
    "prediction_log": f"""{R},{CHECKED}
SELECT CAST(r.recorded_at AS DATE) AS target_date, 'v1.0' AS model_version, 2 * count(*) AS n_predictions,
       CAST(2 AS BIGINT) AS n_runs, count(DISTINCT r.segment_id) AS n_segments
FROM checked c JOIN readings r ON r.id = c.id WHERE errors = '' GROUP BY 1""",
    "stream_status": f"""{with_(READINGS, SEGMENTS, STATUS)}
SELECT segment_id, avg_speed_kmh, vehicle_count, congestion_level, weather_condition, recorded_at
FROM newest""",
    "stream_hourly": f"{R},{CLOSED_HOURS}",
    "stream_hourly_corrected": f"{R},{CLOSED_HOURS}",
    "importance_sum": "SELECT 18::BIGINT AS n_features, TRUE AS sums_to_one, TRUE AS none_negative",
    "model_info": """
SELECT TRUE AS loaded, 'RandomForestClassificationModel' AS model_type, 18 AS n_features, 10 AS n_trees,
       CAST(NULL AS VARCHAR) AS metrics""",
    "model_info_metrics": f"""{RSC},
levels(label) AS (VALUES (0), (1), (2), (3))
SELECT TRUE AS loaded, 18 AS n_features, label, count(clean.id) AS n_test, TRUE AS accuracy_fits
FROM levels LEFT JOIN clean ON congestion_level = label AND epoch_us(recorded_at) >= {CUTOFF} GROUP BY label""",
    "stream_score_check": "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM events",
}

