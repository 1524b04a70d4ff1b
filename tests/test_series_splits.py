from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowgauge.operators import series, splits
from flowgauge.plans import adapters as src

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    rows = src.readings(spark, "/root/testdata/sf0.001")
    rows = rows.withColumn(
        "segment_id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("segment_id"))
    )
    burst = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    return rows.withColumn(
        "recorded_at", F.when(F.col("id") % 9 == 0, burst).otherwise(F.col("recorded_at"))
    ).cache()


def readings(spark, rows):
    rows = [(i, k, START + timedelta(minutes=m), v) for i, (k, m, v) in enumerate(rows)]
    return spark.createDataFrame(
        rows, "id bigint, segment_id string, recorded_at timestamp_ntz, avg_speed_kmh double"
    )


def test_row_lags_and_rolling(spark):
    df = readings(spark, [("a", 30 * i, float(i)) for i in range(50)] + [("b", 0, 7.0)])
    rows = {(r.segment_id, r.id): r for r in series.lag_rolling(df).collect()}
    assert rows["a", 0].speed_lag1h is None
    assert rows["a", 2].speed_lag1h == 0.0
    assert rows["a", 49].speed_lag24h == 1.0
    assert rows["a", 0].speed_rolling3h == 0.0
    assert rows["a", 10].speed_rolling3h == 7.5
    assert rows["b", 50].speed_lag24h is None
    filled = series.lag_rolling(df, fill=1.5, include_current=False).collect()
    rows = {r.id: r for r in filled}
    assert rows[0].speed_rolling3h == 1.5 and rows[10].speed_rolling3h == 6.5


def test_time_frames_skip_gaps(spark):
    df = readings(spark, [("a", 0, 10.0), ("a", 60, 20.0), ("a", 180, 30.0), ("a", 181, None), ("a", 600, 50.0)])
    rows = {r.id: r for r in series.time_lag_rolling(df).collect()}
    assert rows[1].speed_lag1h == 10.0
    assert rows[2].speed_lag1h == 20.0  # two hours old, the tolerance's edge
    assert rows[4].speed_lag1h is None
    assert (rows[2].speed_rolling3h, rows[2].speed_rolling3h_n) == (20.0, 3)
    assert (rows[3].speed_rolling3h, rows[3].speed_rolling3h_n) == (25.0, 3)
    assert rows[4].speed_rolling3h_n == 1


@pytest.mark.parametrize("limits", [{"slice_rows": 50}, {"frame_rows": 3}])
def test_running_sums_equal_range_windows(skewed, limits):
    def values(**options):
        rows = series.time_lag_rolling(skewed, **options).collect()
        return {
            r.id: (r.speed_lag1h, r.speed_lag24h, r.speed_rolling3h, r.speed_rolling3h_n) for r in rows
        }

    plain, running = values(), values(**limits)
    assert plain.keys() == running.keys()
    for i in plain:
        assert running[i] == pytest.approx(plain[i], nan_ok=True), i


@pytest.mark.parametrize("sorted_rows", [1_000_000, 0])
@pytest.mark.parametrize("ratio", [0.2, 0.5, 0.0])
def test_positional_split_cuts_at_the_exact_row(skewed, monkeypatch, sorted_rows, ratio):
    monkeypatch.setattr(splits, "SORTED_ROWS", sorted_rows)
    order = [r.id for r in skewed.orderBy("segment_id", "recorded_at", "id").select("id").collect()]
    cut = int(len(order) * (1 - ratio))
    train, test = splits.split(skewed, splits.positional_rule(skewed, ratio))
    assert {r.id for r in train.select("id").collect()} == set(order[:cut])
    assert {r.id for r in test.select("id").collect()} == set(order[cut:])


def test_positional_rule_is_a_filter(skewed):
    plan = skewed.filter(splits.positional_rule(skewed))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_chronological_split(skewed):
    train, test = splits.split(skewed, splits.chronological_rule(skewed))
    assert train.count() + test.count() == skewed.count()
    latest = train.agg(F.max("recorded_at")).first()[0]
    assert latest < test.agg(F.min("recorded_at")).first()[0]
    small = splits.chronological_rule(skewed, buffer_rows=0)
    assert train.filter(~small).isEmpty() and test.filter(small).isEmpty()


def test_split_of_nothing(skewed):
    none = skewed.filter("false")
    for rule in (splits.positional_rule(none), splits.chronological_rule(none)):
        train, test = splits.split(none, rule)
        assert train.count() == 0 and test.count() == 0


@pytest.mark.parametrize("limit", [20, 5_000_000])
def test_global_positions(skewed, limit):
    plain = F.row_number().over(Window.orderBy("segment_id", "recorded_at", "id")) - 1
    rows = splits.global_positions(skewed, slice_rows=limit).withColumn("q", plain)
    assert rows.count() == skewed.count() and rows.filter("position != q").isEmpty()


def expected_folds(labels, k):
    """Blocks per class, sized by dealing the classes end to end over the folds."""
    classes = list(dict.fromkeys(labels))
    dealt = [c for c in classes for label in labels if label == c]
    blocks = {
        c: [f for f in range(k) for _ in range(dealt[f::k].count(c))] for c in classes
    }
    nth = {c: iter(blocks[c]) for c in classes}
    return [next(nth[label]) for label in labels]


@pytest.mark.parametrize("limit", [20, 5_000_000])
@pytest.mark.parametrize("k", [3, 5])
def test_stratified_folds(skewed, k, limit):
    rows = splits.stratified_folds(skewed, k, slice_rows=limit)
    rows = rows.orderBy("segment_id", "recorded_at", "id").collect()
    assert [r.fold for r in rows] == expected_folds([r.congestion_level for r in rows], k)


def test_zoned_times_cut_the_same(skewed, monkeypatch):
    zoned = skewed.withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
    train, _ = splits.split(skewed, splits.positional_rule(skewed))
    expected = {r.id for r in train.select("id").collect()}
    for rows in (200_000, 0):
        monkeypatch.setattr(splits, "SORTED_ROWS", rows)
        train, _ = splits.split(zoned, splits.positional_rule(zoned))
        assert {r.id for r in train.select("id").collect()} == expected


def test_rows_without_a_key_stay(skewed):
    """The hot key's rows lose their key; nothing else changes."""
    keyless = skewed.withColumn("segment_id", F.when(F.col("segment_id") != 1, F.col("segment_id")))
    n = keyless.count()
    for limit in (20, 5_000_000):
        positions = splits.global_positions(keyless, slice_rows=limit).select("position")
        assert positions.count() == n and positions.distinct().count() == n
        assert splits.stratified_folds(keyless, 3, slice_rows=limit).count() == n
        lagged = series.lag_rolling(keyless, slice_rows=limit).select("id", "speed_lag24h")
        plain = series.lag_rolling(keyless, largest=0).select("id", "speed_lag24h")
        assert lagged.exceptAll(plain).isEmpty() and lagged.count() == n
    for ratio in (0.2, 0.9):
        train, test = splits.split(keyless, splits.positional_rule(keyless, ratio))
        assert (train.count(), test.count()) == (int(n * (1 - ratio)), n - int(n * (1 - ratio)))
