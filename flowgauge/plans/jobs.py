"""The two batch jobs: readings to train/test tables, tables to a model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from flowgauge.functions import codes
from flowgauge.operators import cleaning, encoding, enrich, series, splits, training
from flowgauge.operators.metrics import score_summary
from flowgauge.operators.quantiles import medians
from flowgauge.operators.slices import SLICE_ROWS, group_sizes
from flowgauge.session import dealt, settle
from flowgauge.sources import tables

ONE_HOT = {"district_code": "dist", "road_type": "road"}


@dataclass
class FeatureFit:
    """What the feature job learns from the data before it transforms it."""

    fill_values: dict[str, float | None]
    speed_median: float | None
    categories: dict[str, list]  # none if the job makes no 0/1 columns


def fit_features(
    readings: DataFrame,
    segments: DataFrame,
    key: str = "segment_id",
    rows: int | None = None,
    one_hot: bool = True,
) -> FeatureFit:
    """Medians of the joined readings and of the cleaned speed; categories.

    Categories are those of segments that have readings. ``rows`` is a known
    bound for the number of readings. The joined columns that are asked are
    written once, so the questions join and read nothing else again.
    """
    asked = ["avg_speed_kmh", "vehicle_count", "weather_condition", "is_holiday", "congestion_level"]
    joined = settle(enrich.join_segments(readings, segments, key).select(*asked, *ONE_HOT))
    fill_values = cleaning.fit_fill_values(joined, at_most=rows)
    clean = cleaning.clean_readings(joined, fill_values)
    if not one_hot:
        return FeatureFit(fill_values, medians(clean, ["avg_speed_kmh"], at_most=rows)["avg_speed_kmh"], {})
    # the segments bound the categories; which of them occur is seen on the way
    encoding.fit_categories(segments, list(ONE_HOT))
    seen = {c: F.collect_set(F.col(c).cast("string")) for c in ONE_HOT}
    found = medians(clean, ["avg_speed_kmh"], at_most=rows, also=seen)
    categories = {c: encoding.in_order(clean, c, found[c]) for c in ONE_HOT}
    return FeatureFit(fill_values, found["avg_speed_kmh"], categories)


def feature_frame(
    readings: DataFrame,
    segments: DataFrame,
    fit: FeatureFit | None = None,
    *,
    key: str = "segment_id",
    ts: str = "recorded_at",
    tie: str = "id",
    include_current: bool = True,
    one_hot: bool = True,
    slice_rows: int = SLICE_ROWS,
    written: bool = False,
) -> DataFrame:
    """Join, clean, calendar, lag/rolling and one-hot columns.

    The readings are written once, dealt evenly, as they are read three times,
    unless they are a written table that was dealt already (``written``).
    Where Spark broadcasts the segments, the only further shuffle of them is
    the one of the lag window. Pass the ``fit`` of the training rows to keep
    test rows out of the medians, and ``include_current=False`` to keep the
    current speed out of the rolling mean. ``one_hot=False`` leaves out the
    0/1 column per district and road type; the categories stay as columns.
    """
    if not written:
        readings = settle(dealt(readings))
    rows, largest = group_sizes(readings, [key])
    if fit is None:
        fit = fit_features(readings, segments, key, rows, one_hot)
    joined = enrich.join_segments(readings, segments, key)
    clean = cleaning.clean_readings(joined, fit.fill_values)
    lagged = series.lag_rolling(
        clean, key, ts, tie, include_current=include_current, fill=fit.speed_median,
        slice_rows=slice_rows, largest=largest,
    )
    dummies = encoding.one_hot(fit.categories, ONE_HOT)
    return enrich.calendar_columns(lagged).withColumns(
        {"is_holiday": F.col("is_holiday").cast("int"), **dummies}
    )


def prepare(
    readings: DataFrame,
    segments: DataFrame,
    path: str,
    *,
    test_ratio: float = 0.2,
    by_position: bool = False,
    leak_free: bool = False,
    one_hot: bool = False,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Feature job: writes the train and test rows below ``path``, returns both.

    The split is chronological, or positional over (key, time) order with
    ``by_position``. ``leak_free`` cuts the readings first and uses that one
    cut for both the medians and the split, and leaves the current row out of
    the rolling mean. No model reads the 0/1 columns of districts and road
    types, so they are made only with ``one_hot``.
    """
    names = {n: options[n] for n in ("key", "ts", "tie") if n in options}

    def cut(rows: DataFrame) -> Column:
        if by_position:
            return splits.positional_rule(rows, test_ratio, **names)
        return splits.chronological_rule(rows, test_ratio, names.get("ts", "recorded_at"))

    if leak_free:
        rule = cut(readings)
        fit = fit_features(readings.filter(rule), segments, names.get("key", "segment_id"), one_hot=one_hot)
        frame = feature_frame(readings, segments, fit, include_current=False, one_hot=one_hot, **options)
    else:
        frame = feature_frame(readings, segments, one_hot=one_hot, **options)
        rule = cut(frame)
    tables.write_sets(splits.tag_sets(frame, rule), path)
    return tables.read_sets(readings.sparkSession, path)


def train_and_evaluate(
    spark: SparkSession,
    path: str,
    model_path: str,
    metrics_path: str,
    *,
    tune: bool = False,
    folds: int = 5,
    features: Sequence[str] = codes.MODEL_FEATURES,
    forest: Mapping | None = None,
    tuning: Mapping | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Training job on ``prepare``'s tables: fit or tune, cross-validate, evaluate, save.

    A tuned model is cross-validated with the parameters that the search found.
    """
    keys = ["segment_id", "recorded_at", "id"]
    columns = [*keys, *features, training.LABEL]
    train, test = (part.select(*columns) for part in tables.read_sets(spark, path))
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    options = dict(forest or {})
    try:
        if tune:
            search = training.tune_forest(train, features=features, **(tuning or {}))
            model, options = search.bestModel, search.best
        else:
            model = training.train_forest(train, features, **options)
        scores = training.cross_validate(train, folds, features, **options)
        cv = score_summary(scores).first()
    finally:
        train.unpersist()
    record = training.evaluate(model, test, features)
    record = training.add_cv_scores(record, cv["cv_mean"], cv["cv_std"])
    training.save_model(model, model_path)
    tables.write_metrics(record, metrics_path)
    return model, tables.read_metrics(spark, metrics_path)
