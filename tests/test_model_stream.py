"""Feature job, training, scoring and the streams."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowgauge.functions import codes
from flowgauge.operators import scoring, splits, training
from flowgauge.plans import adapters as src
from flowgauge.plans import jobs, queries
from flowgauge.sources import schemas, tables
from flowgauge.streaming import live, windows

SF = "/root/testdata/sf0.001"
FOREST = {"numTrees": 3, "maxDepth": 4}


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    paths = {n: str(folder / n) for n in ("data", "model", "metrics")}
    train, test = jobs.prepare(
        src.readings(spark, SF), src.segments(spark, SF), paths["data"]
    )
    model, record = jobs.train_and_evaluate(
        spark, *paths.values(), folds=2, forest=FOREST
    )
    return {"paths": paths, "train": train, "test": test, "model": model, "record": record.first()}


def test_prepare_splits_in_time(trained):
    train, test = trained["train"], trained["test"]
    share = train.count() / (train.count() + test.count())
    assert 0.78 < share < 0.82
    assert set(codes.MODEL_FEATURES) <= set(train.columns)
    for name in codes.MODEL_FEATURES:
        assert train.filter(F.col(name).isNull()).isEmpty()


def test_metrics_record(trained):
    record = trained["record"]
    cells = record.confusion_matrix
    total = sum(map(sum, cells))
    assert total == trained["test"].count()
    assert record.accuracy == pytest.approx(sum(cells[i][i] for i in range(4)) / total, abs=1e-4)
    assert record.n_features == 18 and record.feature_names == codes.MODEL_FEATURES
    assert 0 <= record.cv_mean <= 1 and record.cv_std >= 0


def test_saved_model_scores_the_same(spark, trained):
    loaded = training.load_model(trained["paths"]["model"])
    a, b = (
        [r.prediction for r in m.transform(trained["test"]).orderBy("id").collect()]
        for m in (trained["model"], loaded)
    )
    assert a == b


def test_importances_and_info(spark, trained):
    rows = training.feature_importances(spark, trained["model"], limit=None).collect()
    assert len(rows) == 18 and sum(r.importance for r in rows) == pytest.approx(1.0)
    record = tables.read_metrics(spark, trained["paths"]["metrics"])
    info = training.model_info(spark, trained["model"], record).first()
    assert info.loaded and info.n_features == 18 and info.n_trees == 3
    assert json.loads(info.metrics)["n_features"] == 18
    assert training.model_info(spark, None).first().loaded is False


def test_positional_and_leak_free_preparation(spark, tmp_path):
    readings, segments = src.readings(spark, SF), src.segments(spark, SF)
    train, test = jobs.prepare(readings, segments, str(tmp_path / "a"), by_position=True)
    assert train.agg(F.max("segment_id")).first()[0] <= test.agg(F.min("segment_id")).first()[0]
    frame, _ = jobs.prepare(readings, segments, str(tmp_path / "b"), leak_free=True)
    assert frame.filter("speed_rolling3h IS NULL").isEmpty()


def test_tuning_tries_the_grid(trained):
    found = training.tune_forest(
        trained["train"], grid={"numTrees": [2], "maxDepth": [2, 3]}, folds=2
    )
    assert len(found.avgMetrics) == 2 and max(found.avgMetrics) > 0


def test_grids_have_the_published_sizes():
    def size(grid):
        n = 1
        for values in grid.values():
            n *= len(values)
        return n

    assert size(training.QUICK_GRID) == 12
    assert size(training.FULL_GRID) == 27


def test_batch_scoring_isolates_bad_rows(spark, trained):
    requests = spark.createDataFrame(
        [
            ("ok", 17, 2, 6, False, "rain", None, None, 4),
            ("slow", 7, 1, 6, None, None, 5.0, 0, None),
            ("bad hour", 99, 2, 6, False, "rain", 30.0, 10, 4),
            ("no month", 9, 2, None, False, "clear", 30.0, 10, 4),
        ],
        schemas.REQUESTS,
    )
    rows = {r.segment_id: r for r in scoring.score(requests, trained["model"]).collect()}
    assert set(rows) == {"ok", "slow", "bad hour", "no month"}
    for name in ("ok", "slow"):
        row = rows[name]
        assert row.error is None
        assert sum(row.probabilities.values()) == pytest.approx(1, abs=0.01)
        assert set(row.probabilities) <= set(codes.LEVEL_LABELS.values())
        assert row.confidence == max(row.probabilities.values())
        assert row.congestion_label == codes.LEVEL_LABELS[row.congestion_level]
        assert row.recommendation == codes.RECOMMENDATIONS[row.congestion_level]
    assert "hour must be between 0 and 23" in rows["bad hour"].error
    assert rows["bad hour"].congestion_level is None and rows["bad hour"].probabilities is None
    assert rows["no month"].error == "month is required"


def test_request_features_by_name(spark):
    requests = spark.createDataFrame(
        [("a", 17, 2, 6, True, "rain", None, 0, 4), ("b", 3, 6, 6, False, "x", 70.0, 9, 2)],
        schemas.REQUESTS,
    )
    rows = scoring.request_features(requests).collect()
    assert (rows[0].avg_speed_kmh, rows[0].vehicle_count, rows[0].is_holiday) == (12.0, 300, 1)
    assert (rows[1].speed_lag1h, rows[1].speed_rolling3h, rows[1].weather_encoded) == (70.0, 70.0, 0)
    known = requests.withColumn("speed_lag1h", F.lit(1.0))
    assert scoring.request_features(known).first().speed_lag1h == 1.0


def test_prediction_table(spark, trained, tmp_path):
    requests = src.requests(spark, SF)
    rows = scoring.prediction_rows(requests, trained["model"])
    tables.append_predictions(rows, str(tmp_path / "p"))
    stored = tables.conform(spark.read.parquet(str(tmp_path / "p")), "predictions")
    row = stored.first()
    assert json.loads(row.input_features)["segment_id"] is not None
    assert row.model_version == "v1.0" and row.predicted_level in codes.LEVELS
    assert dict(stored.dtypes)["confidence_score"] == "decimal(4,3)"


def test_every_request_is_predicted_or_refused(spark, trained):
    requests = src.requests(spark, SF)
    predicted = scoring.prediction_rows(requests, trained["model"])
    refused = scoring.refused_rows(requests, carry=["id"])
    errors = scoring.score(requests, trained["model"], carry=["id"]).filter("error IS NOT NULL").select("id", "error")
    assert refused.select("id", "error").exceptAll(errors).isEmpty() and refused.count() == errors.count() > 0
    assert predicted.count() + refused.count() == requests.count()
    assert refused.filter("input_features IS NULL").isEmpty()


# ---- streams ----------------------------------------------------------------

SCHEMA = "id bigint, segment_id string, recorded_at timestamp, avg_speed_kmh double, congestion_level int"


def write(spark, folder, rows):
    rows = [(i, k, datetime.fromisoformat(t), v, c) for i, k, t, v, c in rows]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def test_status_ignores_late_rows_and_repeats(spark, tmp_path):
    source, out, state = (tmp_path / n for n in ("in", "out", "state"))
    names = ["avg_speed_kmh", "congestion_level", "recorded_at"]

    def run():
        stream = spark.readStream.schema(SCHEMA).parquet(str(source))
        live.start_status(stream, str(out), str(state), columns=names, availableNow=True).awaitTermination()
        rows = live.read_status(spark, str(out), columns=names).collect()
        return {r.segment_id: r.avg_speed_kmh for r in rows}

    write(spark, source, [(1, "a", "2024-01-01 10:00:00", 1.0, 0), (2, "b", "2024-01-01 10:00:00", 2.0, 0)])
    assert run() == {"a": 1.0, "b": 2.0}
    write(
        spark, source,
        [(3, "a", "2024-01-01 09:00:00", 9.0, 0), (4, "b", "2024-01-01 10:00:00", 4.0, 0), (5, "c", "2024-01-01 08:00:00", 5.0, 0)],
    )
    assert run() == {"a": 1.0, "b": 4.0, "c": 5.0}
    assert run() == {"a": 1.0, "b": 4.0, "c": 5.0}


def test_hourly_windows_close_once_and_drop_late_rows(spark, tmp_path):
    source, out, state = (tmp_path / n for n in ("in", "out", "state"))

    def run():
        stream = live.hourly_windows(spark.readStream.schema(SCHEMA).parquet(str(source)))
        live.start_append(stream, str(out), str(state), availableNow=True).awaitTermination()
        rows = spark.read.schema(stream.schema).parquet(str(out)).collect()
        return {r.window_start.hour: (r.record_count, r.avg_speed) for r in rows}

    write(spark, source, [(1, "a", "2024-01-01 10:10:00", 10.0, 0), (2, "a", "2024-01-01 10:50:00", 20.0, 2), (3, "a", "2024-01-01 11:05:00", 1.0, 0)])
    assert run() == {}
    write(spark, source, [(4, "a", "2024-01-01 10:59:00", 30.0, 0), (5, "a", "2024-01-01 12:30:00", 1.0, 0)])
    assert run() == {10: (3, 20.0), 11: (1, 1.0)}
    write(spark, source, [(6, "a", "2024-01-01 10:00:00", 99.0, 0)])
    assert run() == {10: (3, 20.0), 11: (1, 1.0)}


def _windows(spark, tmp_path, publish_every, by=()):
    source, out, state = (tmp_path / n for n in ("in", "out", "state"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(source))
    windows.start_windows(stream, str(out), str(state), by=by, publish_every=publish_every, availableNow=True).awaitTermination()
    rows = windows.read_windows(spark, str(out), by).collect()
    late = sorted(r.id for r in windows.read_late(spark, str(out)).collect())
    return {(r.window_start.day, r.window_start.hour, *(r[b] for b in by)): (r.record_count, r.avg_speed, r.n_late) for r in rows}, late


@pytest.mark.parametrize("publish_every", [1, 2, 50])
def test_late_readings_correct_closed_windows(spark, tmp_path, publish_every):
    source = tmp_path / "in"

    def run():
        return _windows(spark, tmp_path, publish_every)

    write(spark, source, [(1, "a", "2024-01-01 10:10:00", 10.0, 0), (2, "a", "2024-01-01 10:50:00", 20.0, 2), (3, "a", "2024-01-01 11:05:00", 1.0, 0)])
    assert run() == ({}, [])
    write(spark, source, [(4, "a", "2024-01-01 10:59:00", 30.0, 0), (5, "a", "2024-01-02 12:30:00", None, 0)])
    first = {(1, 10): (3, 20.0, 0), (1, 11): (1, 1.0, 0)}
    assert run() == (first, [])
    write(spark, source, [(6, "a", "2024-01-01 10:00:00", 100.0, 0), (7, "a", "2024-01-02 12:10:00", None, 1), (8, "a", "2024-01-01 08:30:00", None, 1)])
    corrected = {**first, (1, 10): (4, 40.0, 1), (1, 8): (1, None, 1)}
    assert run() == (corrected, [6, 8])
    assert run() == (corrected, [6, 8])  # nothing new: nothing added
    write(spark, source, [(9, "a", "2024-01-02 13:20:00", 1.0, 0)])
    assert run() == ({**corrected, (2, 12): (2, None, 0)}, [6, 8])


def test_readings_without_time_go_to_the_side_output(spark, tmp_path):
    rows = [(1, "a", None, 1.0, 0), (2, None, datetime(2024, 1, 1, 10), 2.0, None), (3, "b", datetime(2024, 1, 1, 12), 2.0, 0)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    assert _windows(spark, tmp_path, 1, ["segment_id"]) == ({(1, 10, None): (1, 2.0, 0)}, [1])


def test_a_repeated_publication_adds_nothing(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for n, hour in enumerate(("10", "12", "10", "14")):
        write(spark, source, [(n, "a", f"2024-01-01 {hour}:00:00", float(n), 0)])
        found, late = _windows(spark, tmp_path, 2)
    assert found == {(1, 10): (2, 1.0, 1), (1, 12): (1, 1.0, 0)} and late == [2]
    windows.publish(spark, out, 3)
    (tmp_path / "out/windows/batch_id=3/_SUCCESS").unlink()  # as if it had died half way
    assert _windows(spark, tmp_path, 2) == (found, late)
    windows.publish(spark, out, 3)
    assert _windows(spark, tmp_path, 2) == (found, late)


def test_stream_scoring_equals_batch(spark, trained, tmp_path):
    requests = src.requests(spark, SF)
    requests.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(requests.schema).parquet(str(tmp_path / "in"))
    scored = live.score_stream(stream, trained["model"], carry=["id"])
    live.start_append(scored, str(tmp_path / "out"), str(tmp_path / "s"), availableNow=True).awaitTermination()
    columns = ["id", "congestion_level", "confidence", "error"]
    live_rows = spark.read.parquet(str(tmp_path / "out")).select(columns)
    batch_rows = scoring.score(requests, trained["model"], carry=["id"]).select(columns)
    assert live_rows.exceptAll(batch_rows).isEmpty() and live_rows.count() == requests.count()


def test_requests_of_one_row_group_are_scored_in_many_tasks(spark, trained):
    assert src.table(spark, SF, "events").rdd.getNumPartitions() == 1
    scored = scoring.score(src.requests(spark, SF), trained["model"], carry=["id"])
    assert scored.rdd.getNumPartitions() == 4
    assert scored.count() == src.readings(spark, SF).count()


def test_features_of_one_row_group_are_made_of_dealt_readings(spark):
    frame = jobs.feature_frame(src.readings(spark, SF), src.segments(spark, SF))
    parts = {Path(f).parent for f in frame.inputFiles()} - {Path(SF)}
    files = [[f for f in folder.iterdir() if f.suffix == ".parquet"] for folder in (Path(str(p)[5:]) for p in parts)]
    assert 4 in map(len, files) and frame.count() <= src.readings(spark, SF).count()


def test_model_training_reads_events_once_and_cuts_dealt_readings(spark, monkeypatch):
    tables_read, cut_of = [], []
    table, rule = src.table, splits.chronological_rule
    monkeypatch.setattr(src, "table", lambda *a: tables_read.append(a[2]) or table(*a))
    monkeypatch.setattr(splits, "chronological_rule", lambda df, *a, **k: cut_of.append(df) or rule(df, *a, **k))
    train = queries._train_frame(spark, SF)
    assert tables_read.count("events") == 1
    files = [Path(f[7:] if f.startswith("file://") else f[5:]) for f in cut_of[0].inputFiles()]
    assert len(files) == 4 and "events.parquet" not in {f.name for f in files}
    assert 0 < train.count() < src.readings(spark, SF).count()


def test_requests_are_dealt_before_they_are_made_of_events(spark):
    plan = src.requests(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Repartition") :]
    assert "get_json_object" in plan[: plan.index("Repartition")] and "get_json_object" not in below
