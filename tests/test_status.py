from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import status

SEGMENTS = "segment_id string, street_name string, district_code string, lat double, lon double"
READINGS = (
    "id bigint, segment_id string, recorded_at timestamp_ntz, hour int, avg_speed_kmh double,"
    "vehicle_count int, congestion_level int, weather_condition string"
)


@pytest.fixture(scope="module")
def segments(spark):
    return spark.createDataFrame(
        [
            ("a", "A street", "d1", 1.0, 2.0),
            ("b", "B street", "d2", 0.0, 2.0),
            ("c", "C street", None, None, 2.0),
            ("e", "E street", "d1", 1.0, 2.0),
        ],
        SEGMENTS,
    )


@pytest.fixture(scope="module")
def readings(spark):
    def at(h, m=0):
        return datetime(2024, 1, 1, h, m)

    return spark.createDataFrame(
        [
            (1, "a", at(8), 8, 50.0, 10, 0, "clear"),
            (2, "a", at(9), 9, 10.0, 20, 2, "rain"),
            (3, "a", at(9), 9, 5.0, 30, 3, "rain"),  # same time, later id
            (4, "b", at(7), 7, None, None, 3, None),
            (5, "x", at(7), 7, 1.0, 1, 3, "clear"),  # no such segment
            (6, "e", at(6), 6, 30.0, 40, 7, "fog"),  # unknown level
        ],
        READINGS,
    )


def test_latest_wins_and_ties_take_the_larger_id(segments, readings):
    rows = {r.segment_id: r for r in status.current_status(segments, readings).collect()}
    assert set(rows) == {"a", "b", "c", "e"}
    assert rows["a"].avg_speed_kmh == 5.0 and rows["a"].status_label == "Kẹt nặng"
    assert rows["a"].status_color == "#c0392b"
    assert rows["b"].avg_speed_kmh is None and rows["b"].congestion_level == 3
    assert rows["c"].recorded_at is None and rows["c"].status_label is None
    assert rows["e"].status_label is None


def test_as_of_bounds_the_latest(segments, readings):
    past = F.lit("2024-01-01 08:30:00").cast("timestamp_ntz")
    rows = {r.segment_id: r for r in status.current_status(segments, readings, as_of=past).collect()}
    assert rows["a"].avg_speed_kmh == 50.0


def test_hotspots_order_and_bounds(segments, readings):
    now = status.current_status(segments, readings).filter("segment_id != 'e'")
    top = [(r.segment_id, r.rank) for r in status.hotspots(now).orderBy("rank").collect()]
    assert top == [("c", 1), ("a", 2), ("b", 3)]  # no data first, then 3/5.0, then 3/NULL
    seen = status.hotspots(now, 1, observed_only=True).collect()
    assert [r.segment_id for r in seen] == ["a"]
    for bad in (0, 51):
        with pytest.raises(ValueError):
            status.hotspots(now, bad)


def test_summary_counts_missing_as_level_zero(segments, readings):
    now = status.current_status(segments, readings)
    row = status.level_summary(now).first()
    assert row.asDict() == {
        "thong_thoang": 1, "cham": 0, "ket_nhe": 0, "ket_nang": 2,
        "total_segments": 4, "n_no_data": 1,
    }
    empty = status.level_summary(now.filter("false")).first()
    assert empty.total_segments == 0 and empty.ket_nang == 0


def test_realtime_filter_is_optional(segments, readings):
    now = status.current_status(segments, readings)
    assert status.realtime(now).count() == 4
    assert [r.segment_id for r in status.realtime(now, "d1").collect()] == ["e", "a"]
    assert status.realtime(now, "nowhere").count() == 0


def test_history_window_limit_and_bounds(readings):
    as_of = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    rows = status.history(readings, "a", 1, as_of=as_of).collect()
    assert [r.avg_speed_kmh for r in rows] == [5.0, 10.0]
    rows = status.history(readings, "a", 2, as_of=as_of, limit=1).collect()
    assert [r.avg_speed_kmh for r in rows] == [5.0]
    early = F.lit("2024-01-01 08:00:00").cast("timestamp_ntz")
    assert status.history(readings, "a", 1, as_of=early).count() == 3  # no upper bound
    assert status.history(readings, "a", 1, as_of=early, until_as_of=True).count() == 1
    for bad in (0, 169):
        with pytest.raises(ValueError):
            status.history(readings, "a", bad)


def test_lookup_district_join_and_coordinates(spark, segments):
    districts = spark.createDataFrame([("d1", "One"), ("d9", "Nine")], "code string, name string")
    rows = status.segments_with_district(segments, districts).collect()
    assert [(r.segment_id, r.district_name) for r in rows] == [("a", "One"), ("e", "One")]
    assert status.segments_with_district(segments, districts, "d9").count() == 0
    assert status.find_by_key(segments, "segment_id", "b").count() == 1
    assert status.find_by_key(segments, "segment_id", "zz").count() == 0
    assert status.located(segments, ["lat", "lon"]).count() == 3
    assert status.located(segments, ["lat", "lon"], zero_is_missing=True).count() == 2


def test_latest_plan_combines_before_the_shuffle(readings):
    plan = status.latest_per_key(readings)._jdf.queryExecution().toString()
    assert "partial_max_by" in plan and "Window" not in plan
