"""Cleaning, quality, joins, encoding, scaling, metrics and the sources."""

import contextlib
import io
import json
import math
import random
import re
from collections import Counter
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from flowgauge.functions import calendar as cal
from flowgauge.functions import codes
from flowgauge.functions.numeric import clamp, mean_as_decimal, missing_or_zero
from flowgauge.operators import cleaning, encoding, enrich, metrics, quality, scaling, stats, status, training
from flowgauge.sources import schemas, tables


def at(text):
    return datetime.fromisoformat(text)


# ---- rules ------------------------------------------------------------------


def test_code_rules_at_their_bounds(spark):
    df = spark.createDataFrame(
        [(45.0, 0.2), (44.99, 0.19), (20.0, 0.5), (8.0, 0.75), (7.9, 0.74), (None, None)],
        "v double, p double",
    )
    rows = df.select(codes.speed_to_level(F.col("v")), codes.probability_to_level(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [(0, 1), (1, 0), (1, 2), (2, 3), (3, 2), (None, None)]


def test_weather_profile_and_fallback(spark):
    df = spark.createDataFrame(
        [("heavy_rain", 17, 2), ("hail", 17, 6), (None, 3, 0), ("fog", 16, 5)],
        "w string, hour int, dow int",
    )
    rows = df.select(
        codes.weather_code(F.col("w")),
        codes.is_rainy(F.col("w")),
        codes.fallback_speed(F.col("hour"), F.col("dow")),
        codes.hour_probability(F.col("hour"), F.col("dow")),
        codes.hour_probability(F.col("hour"), F.col("dow"), serving=True),
    ).collect()
    assert [tuple(r)[:3] for r in rows] == [
        (3, True, 12.0), (0, False, 30.0), (0, False, 55.0), (1, False, 30.0),
    ]
    assert rows[2][3] == 0.05 and rows[2][4] == 0.10
    assert rows[1][3] == 0.90 * 0.65


def test_level_texts(spark):
    row = spark.range(1).select(
        codes.level_speed_estimate(F.lit(0)),
        codes.level_speed_estimate(F.lit(3)),
        codes.level_recommendation(F.lit(2)),
        codes.level_label(F.lit(9)),
    ).first()
    assert tuple(row) == (57.5, 5.0, codes.RECOMMENDATIONS[2], None)


def test_calendar(spark):
    df = spark.createDataFrame([(at("2024-06-02 19:59:00"),), (at("2024-06-03 05:00:00"),)], "t timestamp_ntz")
    parts = df.select(*[c.alias(n) for n, c in cal.date_parts(F.col("t")).items()])
    assert [tuple(r) for r in parts.collect()] == [(19, 6, 6), (5, 0, 6)]
    flags = parts.select(cal.is_weekend(F.col("day_of_week")), cal.is_rush_hour(F.col("hour")))
    assert [tuple(r) for r in flags.collect()] == [(1, 1), (0, 0)]
    sin, cos = cal.cyclic(F.col("hour"), 24)
    row = parts.select(sin, cos).first()
    assert row[0] == pytest.approx(math.sin(2 * math.pi * 19 / 24))
    assert row[1] == pytest.approx(math.cos(2 * math.pi * 19 / 24))


def test_numeric_rules(spark):
    df = spark.createDataFrame([(0,), (None,), (5,)], "n int")
    assert [r[0] for r in df.select(missing_or_zero(F.col("n"), 300)).collect()] == [300, 300, 5]
    assert [r[0] for r in df.select(clamp(F.col("n"), 1, 4)).collect()] == [1, None, 4]
    half = spark.createDataFrame([(0.12,), (0.13,)], "x double")
    assert str(half.agg(mean_as_decimal(F.col("x"), 3, 2)).first()[0]) == "0.13"


# ---- cleaning and quality ---------------------------------------------------


def test_cleaning_fills_then_filters(spark):
    df = spark.createDataFrame(
        [
            (1, 10.0, 5, None, True, 1), (2, None, None, "rain", None, 2),
            (3, float("nan"), 7, "fog", False, 3), (4, 120.0, 2000, "clear", False, 0),
            (5, 120.01, 1, "clear", False, 0), (6, 5.0, 2001, "clear", False, 0),
            (7, -0.1, 1, "clear", False, 0),
        ],
        "id int, avg_speed_kmh double, vehicle_count int, weather_condition string,"
        "is_holiday boolean, congestion_level smallint",
    )
    fill = {"avg_speed_kmh": 33.0, "vehicle_count": 6.0}
    rows = {r.id: r for r in cleaning.clean_readings(df, fill).collect()}
    assert set(rows) == {1, 2, 3, 4}
    assert rows[1].weather_condition == "clear"
    assert (rows[2].avg_speed_kmh, rows[2].vehicle_count) == (33.0, 6.0)
    assert rows[3].avg_speed_kmh == 33.0
    counts = cleaning.outlier_counts(cleaning.fill_readings(df, fill)).first()
    assert tuple(counts) == (7, 4, 3)


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [(0, "a", 24), (1, "a", None), (2, None, -1), (3, "z", 3), (4, None, 4)],
        "id int, k string, hour int",
    )
    ranges = quality.range_violations(df, {"hour": (0, 23)}).collect()
    assert [tuple(r) for r in ranges] == [("hour", 2)]
    nulls = {r.check_name: r.n_violations for r in quality.null_violations(df, ["k", "hour"]).collect()}
    assert nulls == {"k": 2, "hour": 1}
    assert [tuple(r) for r in quality.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    dim = spark.createDataFrame([("a",)], "code string")
    assert [tuple(r) for r in quality.orphan_keys(df, "k", dim, "code").collect()] == [("z", 1)]
    assert [r.id for r in quality.orphan_rows(df, "k", dim, "code").collect()] == [3]
    kept = quality.keep_first(df, ["k"], "id").collect()
    assert sorted(r.id for r in kept) == [0, 2, 3]


@pytest.mark.parametrize("most", [quality.REPEATED_KEYS, 0])
def test_first_row_of_a_key(spark, monkeypatch, most):
    monkeypatch.setattr(quality, "REPEATED_KEYS", most)
    rows = [(i, i // 2 if i < 40 else i, None if i % 7 == 0 else "x", "v") for i in range(200)] + [(500 + i, -1, None, "v") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, k0 int, n string, _k0 string").repartition(5)
    first = {}
    for row in rows:
        first[row[1:3]] = min(first.get(row[1:3], row), row)
    kept = [tuple(r) for r in quality.keep_first(df, ["k0", "n"], "id").collect()]
    assert sorted(kept, key=lambda r: r[0]) == sorted(first.values())
    assert quality.keep_first(df.limit(0), ["k0"], "id").count() == 0


def test_request_rules(spark):
    df = spark.createDataFrame(
        [("a", 23, 6, 12, 120.0, 0, 10), ("b", 24, 7, 0, -1.0, -5, 0), (None, None, 1, 1, None, None, None)],
        "segment_id string, hour int, day_of_week int, month int, avg_speed_kmh double,"
        "vehicle_count int, lanes int",
    )
    checked = quality.request_errors(df)
    rows = [len(r.errors) for r in checked.collect()]
    assert rows == [0, 6, 2]
    good, bad = quality.split_valid(checked)
    assert good.columns == df.columns and good.count() == 1 and bad.count() == 2


# ---- joins ------------------------------------------------------------------


def test_orphans_and_districts_without_segments(spark):
    readings = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None)], "id int, segment_id string")
    segments = spark.createDataFrame([("a", "d", "main", 2)], "segment_id string, district_code string, road_type string, lanes int")
    assert [r.id for r in enrich.join_segments(readings, segments).collect()] == [1]


def test_holidays_and_events(spark):
    readings = spark.createDataFrame(
        [(1, at("2024-01-01 23:59:59")), (2, at("2024-01-02 00:00:00")), (3, at("2024-01-03 12:00:00")), (4, None)],
        "id int, recorded_at timestamp_ntz",
    )
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 1),)], "day date")
    marked = {r.id: r.is_holiday for r in enrich.mark_holidays(readings, days).collect()}
    assert marked == {1: True, 2: False, 3: False, 4: False}
    events = spark.createDataFrame(
        [
            ("long", "x", at("2023-12-31 12:00:00"), at("2024-01-02 00:00:00"), 1),
            ("instant", "x", at("2024-01-03 12:00:00"), at("2024-01-03 12:00:00"), 2),
        ],
        "event_name string, event_type string, start_time timestamp_ntz, end_time timestamp_ntz, impact_level int",
    )
    tagged = [(r.id, r.event_name) for r in enrich.tag_special_events(readings, events).collect()]
    assert sorted(tagged) == [(1, "long"), (2, "long"), (3, "instant")]
    assert enrich.tag_special_events(readings, events, how="left").count() == 4


def test_grid_and_gaps(spark):
    readings = spark.createDataFrame(
        [("a", at("2024-01-01 00:29:59"), 10.0), ("a", at("2024-01-01 00:05:00"), 20.0), ("a", at("2024-01-01 01:00:00"), 5.0),
         ("a", at("2024-01-01 02:00:00"), 1.0)],
        "segment_id string, recorded_at timestamp_ntz, avg_speed_kmh double",
    )
    keys = spark.createDataFrame([("a",), ("b",)], "segment_id string")
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01 00:00:00", "2024-01-01 02:00:00"))
    dense = enrich.densify(readings, keys, start, end)
    assert dense.count() == 8
    first = dense.filter("segment_id = 'a'").orderBy("slot").first()
    assert (first.n_readings, first.mean_value) == (2, 15.0)
    gaps = {r.segment_id: r for r in enrich.slot_gaps(readings, keys, start, end).collect()}
    assert (gaps["a"].n_missing, gaps["a"].first_missing) == (2, at("2024-01-01 00:30:00"))
    assert (gaps["b"].n_observed, gaps["b"].last_missing) == (0, at("2024-01-01 01:30:00"))


# ---- encoding, scaling, statistics ------------------------------------------


def test_one_hot_drops_the_first_category(spark):
    df = spark.createDataFrame([(1, "b", 10), (2, "a", 9), (3, None, 10), (4, "c", None)], "id int, road string, d int")
    found = encoding.fit_categories(df, ["road", "d"])
    assert found == {"road": ["a", "b", "c"], "d": ["9", "10"]}
    columns = encoding.one_hot(found, {"road": "road", "d": "dist"})
    rows = {r.id: r for r in df.select("id", *[c.alias(n) for n, c in columns.items()]).collect()}
    assert rows[1].asDict() == {"id": 1, "road_b": 1, "road_c": 0, "dist_10": 1}
    assert (rows[2].road_b, rows[3].road_b, rows[4].road_c, rows[4].dist_10) == (0, 0, 1, 0)
    with pytest.raises(ValueError):
        encoding.fit_categories(df, ["road"], max_categories=2)


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in (1, 2, 3, 4)], "x double, c double")
    params = scaling.fit_scaling(df, ["x", "c"])
    assert params["x"] == pytest.approx((2.5, math.sqrt(1.25))) and params["c"] == (3.0, 1.0)
    scaled = scaling.zscore(df, params).agg(F.avg("x_z"), F.stddev_pop("x_z"), F.max("c_z")).first()
    assert tuple(scaled) == pytest.approx((0.0, 1.0, 0.0))
    staged = scaling.scaler_stage(params).transform(df).agg(F.stddev_pop("x_z")).first()
    assert staged[0] == pytest.approx(1.0)


def test_class_weights_average_one(spark):
    df = spark.createDataFrame([(c,) for c in [0] * 6 + [1] * 3 + [3]], "congestion_level int")
    weighted = training.with_weights(df)
    weights = {r.congestion_level: r.class_weight for r in weighted.distinct().collect()}
    assert weights == pytest.approx({0: 10 / 18, 1: 10 / 9, 3: 10 / 3})
    mean = weighted.agg(F.avg("class_weight")).first()[0]
    assert mean == pytest.approx(1.0)


def test_statistics(spark):
    df = spark.createDataFrame(
        [(0, 0, 1, 10.0), (0, 0, 2, None), (23, 6, 3, 5.0)],
        "hour int, day_of_week int, congestion_level int, avg_speed_kmh double",
    )
    hourly = stats.hourly_stats(df)
    row = hourly.filter("hour = 0").first()
    assert (str(row.avg_congestion), str(row.avg_speed), row.record_count) == ("1.50", "10.00", 2)
    assert stats.hourly_stats(df, 6).count() == 1
    with pytest.raises(ValueError):
        stats.hourly_stats(df, 7)
    wide = {r.day_of_week: r for r in stats.heatmap(hourly).collect()}
    assert float(wide[6].h23) == 3.0 and wide[6].h00 is None
    shares = stats.class_distribution(df.withColumn("set", F.lit("TRAIN")))
    assert shares.agg(F.sum("percent")).first()[0] == pytest.approx(100)


# ---- metrics ----------------------------------------------------------------


def test_metrics_by_hand(spark):
    pairs = [(0, 0)] * 4 + [(0, 1)] + [(1, 1)] * 2 + [(1, 0)] * 2 + [(3, 0)]
    cells = metrics.confusion(spark.createDataFrame(pairs, "label int, prediction int"))
    assert cells.count() == 16 and cells.agg(F.sum("n")).first()[0] == 10
    row = metrics.overall_scores(cells).first()
    f0, f1 = 2 * 4 / (5 + 7), 2 * 2 / (4 + 3)
    assert row.accuracy == pytest.approx(0.6) and row.n == 10
    assert row.f1_macro == pytest.approx((f0 + f1 + 0) / 3)
    assert row.f1_weighted == pytest.approx((5 * f0 + 4 * f1) / 10)
    report = {r["class"]: r for r in metrics.class_report(cells).collect()}
    assert set(report) == {"0", "1", "3", "accuracy", "macro avg", "weighted avg"}
    assert (report["3"].precision, report["3"].recall, report["3"].support) == (0.0, 0.0, 1)
    matrix = metrics.confusion_array(cells).first()[0]
    assert matrix == [[4, 1, 0, 0], [2, 2, 0, 0], [0, 0, 0, 0], [1, 0, 0, 0]]


def test_score_summary_is_a_population_deviation(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.7)], "fold int, score double")
    assert tuple(metrics.score_summary(df).first()) == pytest.approx((0.6, 0.1, 2))


# ---- sources ----------------------------------------------------------------


def test_missing_table_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "none"))


def test_conform_sets_types_and_defaults(spark):
    raw = spark.createDataFrame([("s1", "Main", "3.5")], "segment_id string, street_name string, length_km string")
    row = tables.conform(raw, "road_segments")
    assert row.first().lanes == 2 and dict(row.dtypes)["length_km"] == "decimal(5,3)"
    for name in schemas.TABLES:
        assert tables.conform(spark.range(1).select(F.lit(None).alias("x")), name).count() == 1


def test_insert_if_absent_twice_adds_once(spark, tmp_path):
    path = str(tmp_path / "segments")
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k string, v int")
    tables.insert_if_absent(new, path, ["k"], "v")
    tables.insert_if_absent(new, path, ["k"], "v")
    tables.insert_if_absent(spark.createDataFrame([("a", 9), ("c", 9)], "k string, v int"), path, ["k"], "v")
    rows = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert rows == [("a", 1), ("b", 3), ("c", 9)]


def test_events_load_once(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = spark.createDataFrame([("x", at("2024-01-01"), at("2024-01-02"))], "event_name string, start_time timestamp, end_time timestamp")
    tables.append_events(rows, path)
    tables.append_events(rows, path)
    assert spark.read.parquet(path).count() == 1


def test_facts_are_partitioned_and_pruned(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = spark.createDataFrame(
        [(i, at(f"2024-01-0{1 + i % 3} 05:00:00")) for i in range(9)], "id int, recorded_at timestamp_ntz"
    )
    tables.append_facts(rows, path)
    tables.append_facts(rows, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 18 and stored.select("date").distinct().count() == 3
    wide = stored.withColumns(
        {c: F.lit(None) for c in ("hour", "avg_speed_kmh", "vehicle_count", "congestion_level", "weather_condition")}
    )
    as_of = F.lit("2024-01-03 06:00:00").cast("timestamp_ntz")
    rows = status.history(wide, 2, 24, as_of=as_of, key="id", date_column="date")
    assert rows.count() == 2
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "(date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_requests_tolerate_bad_lines(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"segment_id": "a", "hour": 3}\n{oops\n{"segment_id": "b", "hour": "x"}\n')
    rows = tables.read_requests(spark, str(tmp_path / "r.json")).cache()
    assert rows.count() == 3
    assert rows.filter("_corrupt_record IS NULL").count() == 1


def test_counts_while_writing(spark, tmp_path):
    assert tables.counts_while_writing(spark.range(7), str(tmp_path / "t"), "t7") == {"n_rows": 7}
    counts = stats.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert sorted(tuple(r) for r in counts.collect()) == [("a", 3), ("b", 0)]


def test_jdbc_options():
    options = tables.jdbc_options(
        "jdbc:postgresql://host/db", "SELECT 1", partition_column="id", lower=0, upper=10, partitions=4, user="u"
    )
    assert options["dbtable"] == "(SELECT 1) AS q"
    assert options["numPartitions"] == "4" and options["user"] == "u" and "password" not in options
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "SELECT 1", partition_column="id")


def test_metrics_sink(spark, tmp_path):
    record = spark.createDataFrame(
        [(0.5, 0.4, 0.3, [[1, 0], [2, 3]], "now", "Forest", 1, ["hour"], 0.1, 0.2)], schemas.METRICS
    )
    tables.write_metrics(record, str(tmp_path / "m"))
    assert tables.read_metrics(spark, str(tmp_path / "m")).first() == record.first()
    (part,) = (tmp_path / "m").glob("part-*.json")
    assert json.loads(part.read_text())["confusion_matrix"] == [[1, 0], [2, 3]]


def test_predictions_are_a_log(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = """segment_id string, predicted_at timestamp, target_datetime timestamp, predicted_level smallint,
                confidence_score decimal(4,3), model_version string, input_features string"""
    at, later, target = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 5, 7)
    first = [("a", at, target, 1, Decimal("0.9"), "v1", "{}"), ("b", at, target, 2, None, None, None)]
    again = [("a", later, target, 3, Decimal("0.9"), "v1", "{}"), ("a", at, datetime(2024, 2, 1), 1, Decimal("0.9"), "v1", "{}")]
    for rows in (first + first, first, again, first + again):
        tables.append_predictions(spark.createDataFrame(rows, schema), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4 and stored.select("id").distinct().count() == 4
    assert {(r.segment_id, r.predicted_level, r.date.isoformat()) for r in stored.collect()} == {
        ("a", 1, "2024-01-05"), ("b", 2, "2024-01-05"), ("a", 3, "2024-01-05"), ("a", 1, "2024-02-01"),
    }


@pytest.mark.parametrize("how", ["inner", "left"])
def test_event_tagging_against_all_pairs(spark, how):
    rng = random.Random(3)
    start = datetime(2020, 1, 1)
    times = [start + timedelta(seconds=rng.randint(0, 10**8)) for _ in range(150)] + [start, None, start]
    lengths = [0, 1, 59, 60, 61, 3600, 86_400, 10**7, 315_360_000]
    events = [(f"e{i}", s, s + timedelta(seconds=rng.choice(lengths))) for i, s in enumerate(t for t in times[:100])]
    events += [("backwards", start + timedelta(days=1), start), ("minute", start, start + timedelta(minutes=1))]
    readings = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "_row int, recorded_at timestamp_ntz")
    table = spark.createDataFrame(events, "event_name string, start_time timestamp_ntz, end_time timestamp_ntz")
    found = enrich.tag_special_events(readings, table, how=how, columns=["event_name"])
    wanted = Counter((i, n) for i, t in enumerate(times) if t for n, a, b in events if a <= t <= b)
    if how == "left":
        wanted += Counter((i, None) for i in range(len(times)) if i not in {x for x, _ in wanted})
    assert found.columns == ["_row", "recorded_at", "event_name"]
    assert Counter((r[0], r[2]) for r in found.collect()) == wanted


def test_event_tags_are_not_shuffled(spark):
    readings = spark.range(40).select("id", F.lit(datetime(2024, 1, 5)).cast("timestamp_ntz").alias("recorded_at"))
    events = spark.range(50).select(
        F.col("id").alias("event_name"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("start_time"),
        F.lit(datetime(2024, 1, 9)).cast("timestamp_ntz").alias("end_time"),
    )
    found = enrich.tag_special_events(readings, events, how="left", columns=["event_name"])
    assert found.count() == 2000
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        found.explain(mode="formatted")
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", plan.getvalue())
    assert moved and not [c for c in moved if "_row" in c and "_tag" in c]  # hits and rows, but no (reading, event)


def test_events_of_a_cell_lie_together_and_are_few(spark, monkeypatch):
    rng = random.Random(5)
    start = datetime(1969, 12, 20)
    times = [start + timedelta(seconds=rng.randint(0, 30 * 86_400)) for _ in range(400)]
    hours = [i * 401 // 200 for i in range(200)]
    events = [(f"e{h}-{i}", t, t + timedelta(hours=h)) for i, (t, h) in enumerate(zip(times, hours))]
    readings = spark.createDataFrame(list(enumerate(times)), "id int, recorded_at timestamp_ntz")
    table = spark.createDataFrame(events, "event_name string, start_time timestamp_ntz, end_time timestamp_ntz")
    written, settle = [], enrich.settle
    monkeypatch.setattr(enrich, "settle", lambda df: written.append(settle(df)) or written[-1])
    found = enrich.tag_special_events(readings, table, how="left", columns=["event_name"])
    wanted = Counter((i, n) for i, t in enumerate(times) for n, a, b in events if a <= t <= b)
    wanted += Counter((i, None) for i in range(len(times)) if i not in {x for x, _ in wanted})
    assert Counter((r[0], r[2]) for r in found.collect()) == wanted

    filed = written[0].withColumn("_file", F.input_file_name()).collect()
    for file in {r["_file"] for r in filed}:  # read in the order written
        cells = [(r["_cell"], r["_first"]) for r in filed if r["_file"] == file]
        assert cells == sorted(cells)
    rows = Counter(r["_tag_event_name"] for r in filed)
    assert all(rows[n] == 1 if a == b else 5 <= rows[n] <= 9 for n, a, b in events)

    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        found.select("*").explain(mode="formatted")  # not run yet, so one plan
    keys = re.findall(r"Left keys \[\d+\]: \[(\w+)#\w+\]", plan.getvalue())  # single numbers
    assert sorted(keys) == ["_cell", "_cell", "_row"]
    assert plan.getvalue().count("REPARTITION_BY_NUM") == 2  # written readings are dealt over tasks of both joins


def test_places_of_long_sparse_vectors(spark):
    positions = spark.range(400_000).select(F.col("id").alias("street"), F.col("id").alias("position"))
    rows = spark.range(4000).select(F.when(F.col("id") < 3998, F.col("id") * 100).alias("street"), F.col("id"))
    rows = rows.withColumn("street", F.when(F.col("id") == 3999, F.lit(-1)).otherwise(F.col("street")))
    size, place = encoding.vector_places("v")
    found = encoding.sparse_one_hot(rows, positions, "street", "v").select("id", size.alias("n"), place.alias("p")).collect()
    assert {r.n for r in found} == {399_999}
    assert {r.id: r.p for r in found} == {i: i * 100 if i < 3998 else 0 for i in range(4000)}


def test_sparse_one_hot_of_many_categories_reaches_a_model(spark):
    rows = spark.range(3001).select(
        F.when(F.col("id") < 3000, F.concat(F.lit("d"), F.lpad((F.col("id") % 1500).cast("string"), 4, "0"))).alias("district"),
        (F.col("id") % 2).cast("int").alias("label"), (F.col("id") % 7).cast("double").alias("x"),
    )
    positions = encoding.category_positions(rows, "district")
    coded = encoding.sparse_one_hot(rows.unionByName(rows.limit(1).withColumn("district", F.lit("new"))), positions, "district", "d")
    at = {r.district: r.d for r in coded.collect()}
    assert {v.size for v in at.values()} == {1499}
    assert not list(at["d0000"].indices) and not list(at["new"].indices) and not list(at[None].indices)
    assert all(list(at[f"d{i:04d}"].indices) == [i - 1] for i in range(1, 1500))
    whole = encoding.assembler(["x", "d"]).transform(coded)
    assert whole.first().features.size == 1500
    assert DecisionTreeClassifier(maxDepth=2).fit(whole).numFeatures == 1500
    with pytest.raises(ValueError):
        encoding.sparse_one_hot(rows, positions.limit(1), "district", "d")
