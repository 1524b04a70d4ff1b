"""Hot keys after a join, odd values in both branches, many classes, loads of NULL keys, long streams."""

import math
import random
from datetime import datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import enrich, quantiles, series, slices, splits, training
from flowgauge.plans import jobs
from flowgauge.sources import tables
from flowgauge.streaming import live

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def joined(spark):
    """40,000 readings, 32,000 of them on one key, that lie by key after a merge join."""
    key = F.when(F.col("id") % 5 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 97))
    readings = spark.range(40_000).select(
        "id", key.alias("segment_id"), F.timestamp_seconds(F.col("id") * 61).cast("timestamp_ntz").alias("recorded_at"),
        (F.col("id") % 71).cast("double").alias("avg_speed_kmh"), (F.col("id") % 3).cast("int").alias("congestion_level"),
    )
    segments = readings.select("segment_id").distinct().withColumn("lanes", F.lit(2))
    return readings.join(segments.hint("merge"), "segment_id")


def largest_share(df, column):
    """Most rows that one task holds; the column is summed so that it is really computed."""
    parts = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.sum(column).alias("s"))
    rows = parts.collect()
    return max(r.n for r in rows), sum(r.s for r in rows if r.s is not None)


def test_a_hot_key_is_spread_after_a_merge_join(spark, joined):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lagged = series.lag_rolling(joined, slice_rows=2000)
        most, total = largest_share(lagged, "speed_rolling3h")
        plain = series.lag_rolling(joined).agg(F.sum("speed_rolling3h")).first()[0]
        assert most < 20_000 and total == pytest.approx(plain)
        numbered = splits.global_positions(joined, slice_rows=2000)
        most, total = largest_share(numbered, "position")
        assert most < 20_000 and total == 40_000 * 39_999 // 2
        folds = splits.stratified_folds(joined, 5, slice_rows=2000)
        most, _ = largest_share(folds, "fold")
        assert most < 20_000
        both = folds.join(splits.stratified_folds(joined, 5).select("id", F.col("fold").alias("plain")), "id")
        assert both.filter("fold <> plain").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def odd_rows(tie):
    rng = random.Random(1)
    values = [0.1234567891, 1e15, 3.5, None, 1e15 + 0.125, 2.0000000001, 7.25, 1234567890.5]
    rows = [(k, START + timedelta(minutes=rng.randint(0, 900)), tie(i), rng.choice(values)) for i, k in enumerate(["a", "b", None] * 60)]
    rows += [("a", None, tie(900), 5.0), ("a", None, tie(901), 6.0), (None, None, tie(902), 1.0), ("nan", START, tie(903), math.nan)]
    rows += [("nan", START + timedelta(minutes=5), tie(904), 2.0), ("big", START, tie(905), 1e300), ("big", START, tie(906), -math.inf)]
    return rows


def same(a, b):
    if a is None or b is None:
        return a is b
    if isinstance(a, float):
        return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("tie,kind", [(lambda i: i, "bigint"), (lambda i: f"id-{i:05d}", "string")])
def test_time_windows_are_equal_in_both_branches(spark, tie, kind):
    df = spark.createDataFrame(odd_rows(tie), f"segment_id string, recorded_at timestamp_ntz, id {kind}, avg_speed_kmh double")
    lags = {"l1": 30, "l2": 200}
    plain = series.time_lag_rolling(df, lag_minutes=lags)
    for slice_rows, frame_rows in ((5, 200), (1_000_000, 2), (3, 1)):
        hot = series.time_lag_rolling(df, lag_minutes=lags, slice_rows=slice_rows, frame_rows=frame_rows)
        assert hot.columns == plain.columns
        a, b = (sorted(x.collect(), key=lambda r: r.id) for x in (plain, hot))
        assert len(a) == len(b) == df.count()
        for x, y in zip(a, b):
            assert all(same(p, q) for p, q in zip(x, y)), (x, y)


def test_median_leaves_nan_out_at_every_size(spark):
    rows = [(float(i),) for i in range(1, 8)] + [(math.nan,)] * 4 + [(None,)]
    df = spark.createDataFrame(rows, "x double")
    for options in ({}, {"buffer_rows": 2}, {"at_most": 12}, {"approx": True}):
        assert quantiles.medians(df, ["x"], **options) == {"x": 4.0}


@pytest.mark.parametrize("kind,values", [
    ("string", ["", "a", "aa", "abcdefgh1", "abcdefgh2", "b", "é", "日本"]),
    ("double", [-1e300, -2.5, -0.5, 0.5, 1.25, 1e300, math.inf, math.nan]),
    ("decimal(9,3)", None),
])
def test_order_numbers_never_fall(spark, kind, values):
    rows = [(v,) for v in values] if values else [(f"{i * 0.37:.3f}",) for i in range(-5, 6)]
    df = spark.createDataFrame(rows, f"v {'string' if values is None else kind}")
    df = df.select(F.col("v").cast(kind))
    numbers = [r.n for r in df.withColumn("n", slices.as_number(df, "v")).orderBy("v").collect()]
    assert None not in numbers and numbers == sorted(numbers)


def test_positions_with_a_string_tie_in_a_hot_key(spark):
    rows = [("a", START + timedelta(minutes=i % 3), f"x{i:03d}", 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "segment_id string, recorded_at timestamp_ntz, id string, v double")
    hot = splits.global_positions(df, slice_rows=4).collect()
    assert [r.id for r in sorted(hot, key=lambda r: r.position)] == [r[2] for r in sorted(rows, key=lambda r: (r[1], r[2]))]


def test_many_classes_and_categories(spark):
    rows = spark.range(6000).select(
        "id", F.lit("s").alias("segment_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("recorded_at"),
        (F.col("id") % 2000).cast("int").alias("congestion_level"),
    )
    folds = splits.stratified_folds(rows, 3)
    per_fold = folds.groupBy("congestion_level").agg(F.count_distinct("fold").alias("n"))
    assert per_fold.count() == 2000 and per_fold.filter("n <> 3").count() == 0
    weights = training.with_weights(rows)
    assert weights.agg(F.avg("class_weight")).first()[0] == pytest.approx(1.0)
    none = rows.withColumn("congestion_level", F.when(F.col("id") > 5, 1))
    assert splits.stratified_folds(none, 2).count() == 6000


def test_feature_job_with_many_districts(spark, tmp_path):
    n = 1500
    segments = spark.range(n).select(
        F.concat(F.lit("s"), "id").alias("segment_id"), F.col("id").cast("int").alias("district_code"),
        F.lit("road").alias("road_type"), F.lit(2).alias("lanes"),
    )
    readings = spark.range(3 * n).select(
        "id", F.concat(F.lit("s"), F.col("id") % n).alias("segment_id"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("recorded_at"),
        F.lit(8).alias("hour"), F.lit(1).alias("day_of_week"), F.lit(1).alias("month"), F.lit(False).alias("is_holiday"),
        F.lit("clear").alias("weather_condition"), (F.col("id") % 60).cast("double").alias("avg_speed_kmh"),
        F.lit(10).alias("vehicle_count"), (F.col("id") % 4).cast("int").alias("congestion_level"),
    )
    train, test = jobs.prepare(readings, segments, str(tmp_path / "sets"))
    assert train.count() + test.count() == 3 * n
    with pytest.raises(ValueError):
        jobs.feature_frame(readings, segments)  # a column per district is refused


@pytest.mark.parametrize("by_position", [False, True])
def test_leak_free_uses_one_cut(spark, tmp_path, monkeypatch, by_position):
    from flowgauge.plans import adapters as src

    readings, segments = src.readings(spark, "/root/testdata/sf0.001"), src.segments(spark, "/root/testdata/sf0.001")
    fitted = []
    fit = jobs.fit_features
    monkeypatch.setattr(jobs, "fit_features", lambda rows, *a, **k: fitted.append(rows) or fit(rows, *a, **k))
    train, test = jobs.prepare(readings, segments, str(tmp_path / "sets"), leak_free=True, by_position=by_position)
    [seen] = fitted
    assert test.count() > 0 and test.join(seen, "id", "left_semi").count() == 0
    assert train.join(seen, "id", "left_anti").count() == 0


def test_tuned_job_validates_the_tuned_model(spark, tmp_path, monkeypatch):
    from flowgauge.plans import adapters as src

    readings, segments = src.readings(spark, "/root/testdata/sf0.001"), src.segments(spark, "/root/testdata/sf0.001")
    jobs.prepare(readings, segments, str(tmp_path / "sets"))
    given = []
    validate = training.cross_validate
    monkeypatch.setattr(training, "cross_validate", lambda *a, **k: given.append(k) or validate(*a, **k))
    paths = [str(tmp_path / n) for n in ("sets", "model", "metrics")]
    tuning = {"grid": {"numTrees": [2], "maxDepth": [2, 3]}, "folds": 2}
    model, _ = jobs.train_and_evaluate(spark, *paths, tune=True, folds=2, tuning=tuning)
    forest = model.stages[-1]
    assert given == [{"numTrees": 2, "maxDepth": forest.getOrDefault("maxDepth")}] and forest.getNumTrees == 2
    with pytest.raises(FileNotFoundError):
        training.load_model(str(tmp_path / "nothing"))
    assert training.load_model(paths[1]).stages[-1].getNumTrees == 2


def test_weights_are_learned_inside_the_fold(spark, monkeypatch):
    rows = spark.range(60).select(
        "id", F.lit("s").alias("segment_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("recorded_at"),
        (F.col("id") % 3 > 0).cast("int").alias("congestion_level"), F.col("id").cast("double").alias("x"),
    )
    seen = []
    weigh = training.with_weights
    monkeypatch.setattr(training, "with_weights", lambda rows, *a: seen.append(rows.count()) or weigh(rows, *a))
    training.cross_validate(rows, 3, ["x"], numTrees=2, maxDepth=2)
    training.tune_forest(rows, grid={"numTrees": [2], "maxDepth": [1]}, folds=3, features=["x"], parallelism=1)
    assert seen == [40, 40, 40, 40, 40, 40, 60]


def test_gaps_of_a_grid_that_starts_off_the_boundary(spark):
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-01 00:10:00", "2024-01-01 03:10:00"))
    minutes = [10, 39, 70, 100, 101, 130, 160]  # the second slot, 00:40, is missing
    rows = [("a", START + timedelta(minutes=m), 1.0) for m in minutes] + [("a", START, 9.0), ("c", START + timedelta(minutes=189), 1.0)]
    rows += [("all", START + timedelta(minutes=10 + 30 * i), 1.0) for i in range(6)] + [("a", None, 1.0)]
    readings = spark.createDataFrame(rows, "segment_id string, recorded_at timestamp_ntz, avg_speed_kmh double")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("all",)], "segment_id string")
    found = {r.segment_id: tuple(r)[1:] for r in enrich.slot_gaps(readings, keys, start, end).collect()}
    at = lambda h, m: datetime(2024, 1, 1, h, m)
    assert found == {
        "a": (6, 5, 1, at(0, 40), at(0, 40)),
        "b": (6, 0, 6, at(0, 10), at(2, 40)),
        "c": (6, 1, 5, at(0, 10), at(2, 10)),
        "all": (6, 6, 0, None, None),
    }
    dense = enrich.densify(readings, keys, start, end)
    assert dense.filter("segment_id = 'a'").agg(F.sum("n_readings")).first()[0] == len(minutes)


def test_null_keys_load_once(spark, tmp_path):
    path = str(tmp_path / "t")
    new = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 2)], "k string, v int")
    for _ in range(2):
        tables.insert_if_absent(new, path, ["k"], "v")
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r.v)
        assert [tuple(r) for r in rows] == [(None, 1), (None, 2), ("a", 2)] or len(rows) == 3
        assert {tuple(r) for r in rows} == {(None, 1), (None, 2), ("a", 2)}


def test_violations_of_base_tables(spark):
    rows = [("a", "x"), ("a", "y"), ("b", None), (None, "z")]
    segments = spark.createDataFrame(rows, "segment_id string, street_name string")
    found = {r.check_name: r.n_violations for r in tables.table_violations(segments, "road_segments").collect()}
    assert found == {"segment_id is required": 1, "street_name is required": 1, "segment_id is unique": 2}


def test_other_errors_are_not_taken_for_a_missing_table(spark, tmp_path):
    (tmp_path / "t.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        tables.exists(spark, str(tmp_path / "t.parquet"))
    assert tables.exists(spark, str(tmp_path / "none")) is False


def test_status_stream_stays_bounded(spark, tmp_path):
    schema = "id bigint, segment_id string, recorded_at timestamp, avg_speed_kmh double, vehicle_count int, congestion_level int, weather_condition string"
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    names = ["recorded_at", "avg_speed_kmh", "congestion_level"]
    for batch in range(9):
        rows = [(batch * 10 + i, f"s{i}", START + timedelta(minutes=batch), float(batch), 1, 0, "clear") for i in range(batch % 3 + 1)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        live.start_status(stream, out, state, columns=names, compact_every=2, availableNow=True).awaitTermination()
        found = {r.segment_id: r.avg_speed_kmh for r in live.read_status(spark, out, columns=names).collect()}
        wanted = {f"s{i}": float(max(b for b in range(batch + 1) if b % 3 >= i)) for i in range(min(batch, 2) + 1)}
        assert found == wanted
    folders = [p.name for kind in ("merged", "changes") for p in (tmp_path / "out" / kind).iterdir() if p.name.startswith("batch_id")]
    assert len(folders) <= 2 + 2 * 2 + 1


PROBE = [1e-11, 1.5e-11, 1e17, 3.25, -1e17, 1e300, 5e-324, None, math.nan, math.inf, -math.inf, 0.1, 0.0]


@pytest.mark.parametrize("values", [[1e-11 * i for i in range(1, 9)], PROBE[:5] * 3, PROBE, [0.1] * 30, [None] * 6])
def test_rolling_means_are_the_same_to_the_last_bit(spark, values):
    rng = random.Random(len(values))
    rows = [("a", START + timedelta(minutes=7 * (i // 2)), i, rng.choice(values)) for i in range(60)]
    df = spark.createDataFrame(rows, "segment_id string, recorded_at timestamp_ntz, id int, avg_speed_kmh double")
    found = [
        {r.id: (repr(r.speed_rolling3h), r.speed_rolling3h_n) for r in series.time_lag_rolling(df, **options).collect()}
        for options in ({}, {"slice_rows": 4}, {"frame_rows": 1})
    ]
    assert found[0] == found[1] == found[2]
    for _, t, i, _ in rows:  # against exact fractions
        inside = [v for _, u, _, v in rows if timedelta(0) <= t - u <= timedelta(minutes=180) and v is not None]
        if not inside:
            assert found[0][i][0] == "None"
        elif all(map(math.isfinite, inside)):
            mean = float(sum(map(Fraction, inside)) / len(inside))
            assert float(found[0][i][0]) == pytest.approx(mean, rel=1e-15)
        else:
            signs = {v for v in inside if math.isinf(v)}
            odd = math.nan if len(signs) != 1 or any(map(math.isnan, inside)) else signs.pop()
            assert same(float(found[0][i][0]), odd)


def test_time_windows_with_names_like_the_internal_ones(spark):
    rows = [(i % 2, START + timedelta(minutes=i), i, float(i), "x", i, 2 * i) for i in range(40)]
    names = ["_hot", "_t", "_n", "avg_speed_kmh", "_slice", "_limb0", "own_t"]
    df = spark.createDataFrame(rows, "_hot int, _t timestamp_ntz, _n int, avg_speed_kmh double, _slice string, _limb0 int, own_t int")
    columns = {"key": "_hot", "ts": "_t", "tie": "_n"}
    plain = series.time_lag_rolling(df, **columns)
    hot = series.time_lag_rolling(df, slice_rows=3, **columns)
    assert plain.columns == hot.columns and plain.columns[:7] == names
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, hot.collect())) != []
