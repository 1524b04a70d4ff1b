"""Every operator as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions import codes
from flowgauge.functions.numeric import clamp
from flowgauge.operators import (
    cleaning,
    encoding,
    enrich,
    metrics,
    quality,
    quantiles,
    scaling,
    scoring,
    series,
    splits,
    stats,
    status,
    training,
)
from flowgauge.operators.slices import group_sizes
from flowgauge.plans import adapters as src
from flowgauge.plans import jobs
from flowgauge.session import scratch_path, settle
from flowgauge.sources import tables
from flowgauge.streaming import live, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF, LATER = "2024-01-31 00:00:00", "2024-01-31 06:00:00"
GRID_START, GRID_END = "2024-01-01 00:00:00", "2024-01-31 00:00:00"
OFFSET_START, OFFSET_END = "2024-01-03 00:10:00", "2024-01-09 06:40:00"
SMALL_FOREST = {"numTrees": 10, "maxDepth": 8}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    return df.withColumns(
        {n: F.round(n, digits) + F.lit(0.0) for n, kind in df.dtypes if kind == "double"}
    )


def _status(spark, sf):
    return status.current_status(src.segments(spark, sf), src.readings(spark, sf))


def _joined(spark, sf):
    return enrich.join_segments(src.readings(spark, sf), src.segments(spark, sf))


def _sizes(spark, sf):
    """(number of readings, readings of the largest key)"""
    return group_sizes(src.readings(spark, sf), ["segment_id"])


def _clean(spark, sf, rows=None):
    joined = _joined(spark, sf)
    fill_values = cleaning.fit_fill_values(joined, at_most=rows or src.readings(spark, sf).count())
    return cleaning.clean_readings(joined, fill_values)


# ---- segments and districts -------------------------------------------------


@query
def segments_with_district(spark, sf):
    return status.segments_with_district(src.segments(spark, sf), src.districts(spark, sf))


@query
def segments_of_district(spark, sf):
    return status.segments_with_district(src.segments(spark, sf), src.districts(spark, sf), 7)


@query
def segment_lookup(spark, sf):
    return status.find_by_key(src.segments(spark, sf), "segment_id", 42)


@query
def districts_sorted(spark, sf):
    return src.districts(spark, sf).orderBy("code")


@query
def segments_located(spark, sf):
    return status.located(_status(spark, sf), ["avg_speed_kmh", "vehicle_count"], zero_is_missing=True)


# ---- current status ---------------------------------------------------------


@query
def current_status(spark, sf):
    return _status(spark, sf)


@query
def realtime_all(spark, sf):
    return status.realtime(_status(spark, sf))


@query
def realtime_district(spark, sf):
    return status.realtime(_status(spark, sf), 7)


@query
def hotspots(spark, sf):
    return status.hotspots(_status(spark, sf), 10)


@query
def hotspots_observed(spark, sf):
    return status.hotspots(_status(spark, sf), 50, observed_only=True)


@query
def level_summary(spark, sf):
    return status.level_summary(_status(spark, sf))


@query
def level_summary_district(spark, sf):
    return status.level_summary(status.optional_equals(_status(spark, sf), "district_code", 7))


@query
def history_one_key(spark, sf):
    return status.history(src.readings(spark, sf), 8, 168, as_of=ntz(AS_OF), limit=200)


# ---- statistics -------------------------------------------------------------


@query
def hourly_stats(spark, sf):
    return stats.hourly_stats(src.readings(spark, sf))


@query
def hourly_stats_one_day(spark, sf):
    return stats.hourly_stats(src.readings(spark, sf), day_of_week=2)


@query
def heatmap_pivot(spark, sf):
    return stats.heatmap(stats.hourly_stats(src.readings(spark, sf)))


@query
def row_counts(spark, sf):
    return stats.row_counts(
        {
            "readings": src.readings(spark, sf),
            "segments": src.segments(spark, sf),
            "districts": src.districts(spark, sf),
        }
    )


@query
def global_medians(spark, sf):
    readings = src.readings(spark, sf)
    values = quantiles.medians(readings, ["avg_speed_kmh", "vehicle_count"])
    # the medians next to the number of rows on either side of them
    return readings.agg(
        F.lit(values["avg_speed_kmh"]).alias("median_speed"),
        F.lit(values["vehicle_count"]).alias("median_vehicles"),
        F.count_if(F.col("avg_speed_kmh") < values["avg_speed_kmh"]).alias("n_slower"),
        F.count_if(F.col("vehicle_count") < values["vehicle_count"]).alias("n_fewer"),
    )


# ---- cleaning and joins -----------------------------------------------------


@query
def clean_readings(spark, sf):
    return _clean(spark, sf)


@query
def fill_missing(spark, sf):
    readings = src.readings(spark, sf)
    return cleaning.fill_readings(readings, cleaning.fit_fill_values(readings))


@query
def outliers_removed(spark, sf):
    joined = _joined(spark, sf)
    return cleaning.outlier_counts(cleaning.fill_readings(joined, cleaning.fit_fill_values(joined)))


@query
def join_dim(spark, sf):
    return _joined(spark, sf)


@query
def holiday_lookup(spark, sf):
    readings = src.readings(spark, sf).select("id", "recorded_at")
    return enrich.mark_holidays(readings, src.holidays(spark))


@query
def event_tagging(spark, sf):
    readings = src.readings(spark, sf).select("id", "segment_id", "recorded_at")
    return enrich.tag_special_events(readings, src.special_events(spark))


@query
def event_tagging_long(spark, sf):
    """Some readings as events of up to 400 hours, many of them at once; readings without one stay."""
    readings = src.readings(spark, sf).select("id", "recorded_at")
    hours = F.make_dt_interval(F.lit(0), (F.col("id") % 401).cast("int"))
    events = readings.filter("id % 331 = 0").select(
        F.concat(F.lit("e"), F.col("id")).alias("event_name"),
        F.col("recorded_at").alias("start_time"),
        (F.col("recorded_at") + hours).alias("end_time"),
    )
    return enrich.tag_special_events(readings, events, how="left", columns=["event_name"])


@query
def slot_gaps(spark, sf):
    readings = src.readings(spark, sf)
    keys = readings.select("segment_id").distinct()
    return enrich.slot_gaps(readings, keys, ntz(GRID_START), ntz(GRID_END))


@query
def slot_gaps_offset(spark, sf):
    """Slots that begin ten minutes past the half hours."""
    readings = src.readings(spark, sf)
    keys = readings.select("segment_id").distinct()
    return enrich.slot_gaps(readings, keys, ntz(OFFSET_START), ntz(OFFSET_END))


@query
def slot_grid_daily(spark, sf):
    readings = src.readings(spark, sf)
    keys = readings.select("segment_id").distinct()
    dense = enrich.densify(readings, keys, ntz(GRID_START), ntz(GRID_END))
    per_day = dense.groupBy("segment_id", F.col("slot").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n_slots"),
        F.sum("n_readings").alias("n_readings"),
        F.avg("mean_value").alias("mean_value"),
    )
    return rounded(per_day)


# ---- rules on values --------------------------------------------------------


@query
def calendar_features(spark, sf):
    columns = [
        "id", "is_weekend", "is_rush_hour", "weather_encoded",
        "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
    ]
    frame = enrich.calendar_columns(src.readings(spark, sf))
    return rounded(
        frame.select(
            *columns,
            F.col("is_holiday").cast("int").alias("is_holiday"),
            codes.is_rainy(F.col("weather_condition")).alias("is_rainy"),
        )
    )


@query
def date_parts(spark, sf):
    readings = src.readings(spark, sf).select("id", "recorded_at")
    return enrich.derive_date_parts(readings)


@query
def speed_level(spark, sf):
    speed = F.col("avg_speed_kmh")
    level = codes.speed_to_level(speed)
    return src.readings(spark, sf).select(
        "id",
        level.alias("level"),
        codes.level_label(level).alias("label"),
        codes.level_color(level).alias("color"),
        codes.level_speed_estimate(level).alias("estimated_speed_kmh"),
        codes.level_recommendation(level).alias("recommendation"),
    )


@query
def hour_profile(spark, sf):
    frame = enrich.hour_profile_columns(src.readings(spark, sf))
    return rounded(frame.select("id", "typical_prob", "typical_level", "fallback_speed"))


@query
def fallback_speed(spark, sf):
    speed = codes.fallback_speed(F.col("hour"), F.col("day_of_week"))
    return src.readings(spark, sf).select("id", speed.alias("fallback_speed"))


@query
def prob_level(spark, sf):
    prob = clamp(F.col("avg_speed_kmh") / F.lit(100.0), 0.0, 1.0)
    frame = src.readings(spark, sf).select("id", prob.alias("prob"))
    return rounded(frame.withColumn("level", codes.probability_to_level(F.col("prob"))))


# ---- series features --------------------------------------------------------


@query
def lag_rolling(spark, sf):
    rows, largest = _sizes(spark, sf)
    frame = series.lag_rolling(_clean(spark, sf, rows), largest=largest)
    return rounded(
        frame.select("id", "segment_id", "speed_lag1h", "speed_lag24h", "speed_rolling3h")
    )


@query
def lag_rolling_filled(spark, sf):
    rows, largest = _sizes(spark, sf)
    clean = _clean(spark, sf, rows)
    speed = quantiles.medians(clean, ["avg_speed_kmh"], at_most=rows)["avg_speed_kmh"]
    frame = series.lag_rolling(clean, include_current=False, fill=speed, largest=largest)
    return rounded(
        frame.select("id", "segment_id", "speed_lag1h", "speed_lag24h", "speed_rolling3h")
    )


@query
def rolling_time_range(spark, sf):
    frame = series.time_lag_rolling(src.readings(spark, sf))
    return rounded(
        frame.select(
            "id", "segment_id", "speed_lag1h", "speed_lag24h", "speed_rolling3h",
            "speed_rolling3h_n",
        )
    )


@query
def one_hot_road(spark, sf):
    segments = src.segments(spark, sf)
    found = encoding.fit_categories(segments, ["road_type"])
    return segments.select(
        "segment_id",
        *[c.alias(n) for n, c in encoding.one_hot(found, {"road_type": "road"}).items()],
    )


@query
def one_hot_street(spark, sf):
    """A vector place for every street but the first: the places with a one, and the vector's length."""
    segments = src.segments(spark, sf)
    positions = encoding.category_positions(segments, "street_name")
    coded = encoding.sparse_one_hot(segments, positions, "street_name", "street")
    size, place = encoding.vector_places("street")
    return coded.select("segment_id", size.alias("n_places"), place.alias("place"))


@query
def feature_frame(spark, sf):
    frame = jobs.feature_frame(settle(src.dealt_readings(spark, sf)), src.segments(spark, sf), written=True)
    return rounded(frame)


# ---- splits, weights, scaling -----------------------------------------------


@query
def split_positional(spark, sf):
    clean = _clean(spark, sf)
    tagged = splits.tag_sets(clean, splits.positional_rule(clean))
    return tagged.select("id", "segment_id", "recorded_at", "set")


@query
def split_time(spark, sf):
    readings = src.readings(spark, sf)
    tagged = splits.tag_sets(readings, splits.chronological_rule(readings))
    return tagged.select("id", "recorded_at", "set")


@query
def global_position(spark, sf):
    return splits.global_positions(
        src.readings(spark, sf).select("id", "segment_id", "recorded_at")
    )


@query
def folds(spark, sf):
    frame = splits.stratified_folds(
        src.readings(spark, sf).select("id", "segment_id", "recorded_at", "congestion_level"), 5
    )
    return frame.select("id", "congestion_level", "fold")


@query
def class_distribution(spark, sf):
    readings = src.readings(spark, sf)
    tagged = splits.tag_sets(readings, splits.chronological_rule(readings))
    return rounded(stats.class_distribution(tagged))


@query
def class_weights(spark, sf):
    return rounded(training.class_weights(src.readings(spark, sf)))


@query
def scaling_parameters(spark, sf):
    columns = ["hour", "day_of_week", "month", "avg_speed_kmh", "vehicle_count"]
    return rounded(scaling.scaling_table(_clean(spark, sf), columns))


@query
def zscore(spark, sf):
    clean = _clean(spark, sf)
    columns = ["hour", "day_of_week", "month", "avg_speed_kmh", "vehicle_count"]
    scaled = scaling.zscore(clean, scaling.fit_scaling(clean, columns))
    return rounded(scaled.select("id", *[f"{c}_z" for c in columns]))


# ---- metrics ----------------------------------------------------------------


@query
def confusion(spark, sf):
    return metrics.confusion(src.pairs(spark, sf))


@query
def class_report(spark, sf):
    return rounded(metrics.class_report(metrics.confusion(src.pairs(spark, sf))))


@query
def f1_scores(spark, sf):
    return rounded(metrics.overall_scores(metrics.confusion(src.pairs(spark, sf))))


# ---- data quality and loading -----------------------------------------------


@query
def dq_ranges(spark, sf):
    ranges = {**quality.READING_RANGES, "avg_speed_kmh": (0, 120), "vehicle_count": (0, 50)}
    return quality.range_violations(src.readings(spark, sf), ranges)


@query
def dq_nulls(spark, sf):
    columns = ["id", "segment_id", "recorded_at", "weather_condition", "avg_speed_kmh", "vehicle_count"]
    return quality.null_violations(src.readings(spark, sf), columns)


@query
def dq_unique(spark, sf):
    return quality.duplicate_keys(
        src.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query
def dq_fk(spark, sf):
    return quality.orphan_keys(
        src.readings(spark, sf), "vehicle_count", src.districts(spark, sf), "code"
    )


@query
def dq_fk_rows(spark, sf):
    rows = quality.orphan_rows(
        src.readings(spark, sf), "vehicle_count", src.districts(spark, sf), "code"
    )
    return rows.select("id", "vehicle_count")


@query
def dq_duplicates(spark, sf):
    lines = src.table(spark, sf, "lineitem")
    return quality.keep_first(
        lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        ["l_orderkey", "l_linenumber"],
        F.struct("l_partkey", "l_suppkey"),
    )


@query
def column_defaults(spark, sf):
    readings = src.readings(spark, sf).select("id", "weather_condition", "vehicle_count")
    return cleaning.fill_defaults(
        readings, {"weather_condition": codes.DEFAULT_WEATHER, "vehicle_count": codes.DEFAULT_VEHICLES}
    )


@query
def insert_if_absent(spark, sf):
    existing = src.readings(spark, sf).select("segment_id")
    return tables.absent_rows(src.segments(spark, sf), existing, ["segment_id"], "street_name")


@query
def validate_requests(spark, sf):
    checked = quality.request_errors(src.requests(spark, sf))
    return checked.select("id", "valid", F.array_join("errors", "; ").alias("errors"))


@query
def request_features(spark, sf):
    frame = scoring.request_features(scoring.with_request_defaults(src.requests(spark, sf)))
    return frame.select(
        "id", "avg_speed_kmh", "speed_lag1h", "speed_lag24h", "speed_rolling3h",
        "vehicle_count", "is_holiday", "weather_encoded",
    )


# ---- model ------------------------------------------------------------------


def _train_frame(spark, sf) -> DataFrame:
    return _frame_sets(spark, sf)[0]


def _frame_sets(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of the feature table; it and the cut read the readings once written."""
    readings = settle(src.dealt_readings(spark, sf))
    frame = jobs.feature_frame(readings, src.segments(spark, sf), written=True)
    return splits.split(frame, splits.chronological_rule(readings))


_MODELS: dict[tuple[str, str], PipelineModel] = {}


def small_model(spark, sf) -> PipelineModel:
    """The small forest of a set of tables, fitted once per application."""
    name = (spark.sparkContext.applicationId, sf)
    if name not in _MODELS:
        _MODELS[name] = _fit_model(spark, sf)
    return _MODELS[name]


def _fit_model(spark, sf) -> PipelineModel:
    train = _train_frame(spark, sf).select(*codes.MODEL_FEATURES, training.LABEL).persist()
    try:
        return training.train_forest(train, **SMALL_FOREST)
    finally:
        train.unpersist()


@query
def score_batch(spark, sf):
    model = small_model(spark, sf)
    scored = scoring.score(src.requests(spark, sf), model, carry=["id"])
    return scored.withColumn("probabilities", F.to_json("probabilities"))


@query
def score_isolation(spark, sf):
    """Which requests are scored, and whether their results fit together."""
    scored = scoring.score(src.requests(spark, sf), small_model(spark, sf), carry=["id"])
    level = F.col("congestion_level")
    odds = F.map_values("probabilities")
    total = F.aggregate(odds, F.lit(0.0), lambda a, b: a + b)
    texts = (F.col("congestion_label") == codes.level_label(level)) & (
        F.col("estimated_speed_kmh") == codes.level_speed_estimate(level)
    )
    # the level is one of the most likely ones, and the confidence is its share
    likeliest = F.element_at("probabilities", F.col("congestion_label")) == F.array_max(odds)
    sums = (F.abs(total - 1) < 0.01) & (F.col("confidence") == F.array_max(odds)) & likeliest
    return scored.select(
        "id",
        "error",
        level.isin(codes.LEVELS).alias("has_level"),
        texts.alias("level_fits"),
        sums.alias("odds_fit"),
    ).fillna(False)


@query
def prediction_rows(spark, sf):
    return scoring.prediction_rows(
        src.requests(spark, sf), small_model(spark, sf), predicted_at=ntz(AS_OF)
    )


@query
def prediction_quarantine(spark, sf):
    """The requests that are refused, and what they asked, read back from JSON."""
    refused = scoring.refused_rows(src.requests(spark, sf), carry=["id"])
    asked = F.from_json("input_features", "segment_id bigint, hour int, lanes int")
    return refused.select(
        "id",
        "segment_id",
        F.col("target_datetime").cast("timestamp_ntz").alias("target_datetime"),
        "error",
        asked["segment_id"].alias("asked_segment"),
        asked["hour"].alias("asked_hour"),
        asked["lanes"].alias("asked_lanes"),
    )


@query
def prediction_log(spark, sf):
    """The log after a load, the same load again, and a later prediction of the same requests."""
    model, path = small_model(spark, sf), scratch_path(spark, "predictions")
    for at in (AS_OF, AS_OF, LATER):
        rows = scoring.prediction_rows(src.requests(spark, sf), model, predicted_at=ntz(at))
        tables.append_predictions(rows, path)
    return spark.read.parquet(path).groupBy(F.col("date").alias("target_date"), "model_version").agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.count_distinct("predicted_at").alias("n_runs"),
        F.count_distinct("segment_id").alias("n_segments"),
    )


@query
def feature_importance(spark, sf):
    return training.feature_importances(spark, small_model(spark, sf))


@query
def importance_sum(spark, sf):
    """All importances: how many, and whether they are shares of one whole."""
    rows = training.feature_importances(spark, small_model(spark, sf), limit=None)
    return rows.agg(
        F.count(F.lit(1)).alias("n_features"),
        (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"),
        (F.min("importance") >= 0).alias("none_negative"),
    )


@query
def cv_scores(spark, sf):
    return metrics.score_summary(
        training.cross_validate(_train_frame(spark, sf), 3, numTrees=5, maxDepth=6)
    )


@query
def tuned_parameters(spark, sf):
    found = training.tune_forest(
        _train_frame(spark, sf), grid={"numTrees": [5], "maxDepth": [4, 8]}, folds=3
    )
    rows = [
        (str(tried), float(score))
        for tried, score in zip(found.tried, found.avgMetrics)
    ]
    return spark.createDataFrame(rows, "parameters string, f1_weighted double")


def _record(spark, sf) -> DataFrame:
    test = _frame_sets(spark, sf)[1]
    return training.evaluate(small_model(spark, sf), test, trained_at=datetime(2024, 1, 31))


@query
def evaluation_record(spark, sf):
    return _record(spark, sf).withColumns(
        {
            "confusion_matrix": F.to_json("confusion_matrix"),
            "feature_names": F.array_join("feature_names", ","),
        }
    )


@query
def model_info(spark, sf):
    return training.model_info(spark, small_model(spark, sf))


@query
def model_info_metrics(spark, sf):
    """Model info with the metrics of the test rows: rows per level, and whether the accuracy is that of the matrix."""
    info = training.model_info(spark, small_model(spark, sf), _record(spark, sf))
    known = "accuracy double, n_features int, confusion_matrix array<array<bigint>>"
    parsed = info.select("loaded", F.from_json("metrics", known).alias("m"))
    rows = parsed.select("loaded", "m.*", F.posexplode("m.confusion_matrix").alias("label", "cells"))
    rows = rows.withColumn("n_test", F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, b: a + b))
    hits, total = rows.agg(F.sum(F.col("cells")[F.col("label")])), rows.agg(F.sum("n_test"))
    same = F.abs(F.col("accuracy") - hits.scalar() / total.scalar()) <= 0.00005001
    return rows.select("loaded", "n_features", "label", "n_test", same.alias("accuracy_fits"))


# ---- streams ----------------------------------------------------------------


def _finish(stream) -> None:
    stream.awaitTermination()


@query
def stream_status(spark, sf):
    out, state = scratch_path(spark, "status"), scratch_path(spark, "state")
    _finish(live.start_status(src.reading_stream(spark, sf), out, state, availableNow=True))
    rows = live.read_status(spark, out)
    return rows.withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz"))


@query
def stream_hourly(spark, sf):
    out, state = scratch_path(spark, "hourly"), scratch_path(spark, "state")
    hours = live.hourly_windows(src.reading_stream(spark, sf))
    _finish(live.start_append(hours, out, state, availableNow=True))
    rows = spark.read.schema(hours.schema).parquet(out)
    return rounded(
        rows.withColumns(
            {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
        )
    )


@query
def stream_hourly_corrected(spark, sf):
    """Readings arrive in four batches without order; late ones correct the closed hours."""
    folder, out, state = (scratch_path(spark, n) for n in ("arrivals", "windows", "state"))
    files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")))
    src.table(spark, sf, "events").repartition(files, "event_id").write.parquet(folder)
    incoming = src.reading_stream(spark, folder, "*.parquet", maxFilesPerTrigger=-(-files // 4))
    _finish(windows.start_windows(incoming, out, state, publish_every=2, availableNow=True))
    rows = windows.read_windows(spark, out).drop("n_late")
    return rounded(
        rows.withColumns(
            {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
        )
    )


@query
def stream_score(spark, sf):
    model = small_model(spark, sf)
    out, state = scratch_path(spark, "scored"), scratch_path(spark, "state")
    incoming = src.reading_stream(spark, sf).withColumn("lanes", (F.col("id") % 12).cast("int"))
    scored = live.score_stream(incoming, model, carry=["id"])
    _finish(live.start_append(scored, out, state, availableNow=True))
    rows = spark.read.schema(scored.schema).parquet(out)
    return rows.withColumn("probabilities", F.to_json("probabilities"))


@query
def stream_score_check(spark, sf):
    """Rows scored on the stream, and those that differ from the same rows scored in a batch."""
    columns = ["id", "segment_id", "congestion_level", "confidence", "estimated_speed_kmh", "error"]
    incoming = src.readings(spark, sf).withColumn("lanes", (F.col("id") % 12).cast("int"))
    batch = scoring.score(incoming, small_model(spark, sf), carry=["id"]).select(columns)
    stream = stream_score(spark, sf).select(columns)
    different = stream.exceptAll(batch).agg(F.count(F.lit(1)).alias("n_different"))
    return stream.agg(F.count(F.lit(1)).alias("n_rows")).join(different)
