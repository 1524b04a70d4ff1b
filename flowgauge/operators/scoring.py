"""Batch scoring of requests with a trained model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions import codes
from flowgauge.functions.numeric import missing_or_zero, round_half_even
from flowgauge.operators.enrich import calendar_columns
from flowgauge.operators.quality import request_errors

REQUEST_DEFAULTS = {
    "is_holiday": False,
    "weather_condition": codes.DEFAULT_WEATHER,
    "lanes": codes.DEFAULT_REQUEST_LANES,
}


def with_request_defaults(requests: DataFrame) -> DataFrame:
    """Optional request fields filled where they are missing."""
    return requests.withColumns(
        {
            n: F.coalesce(F.col(n), F.lit(v)) if n in requests.columns else F.lit(v)
            for n, v in REQUEST_DEFAULTS.items()
        }
    )


def request_features(requests: DataFrame) -> DataFrame:
    """The model's features of each request, by name.

    A missing speed is estimated from the hour; a missing or zero vehicle
    count gets its default. Lag and rolling features already in the table are
    kept, otherwise they stand at the current speed.
    """
    speed = F.coalesce(
        F.col("avg_speed_kmh").cast("double"),
        codes.fallback_speed(F.col("hour"), F.col("day_of_week")),
    )
    filled = requests.withColumns(
        {
            "avg_speed_kmh": speed,
            "vehicle_count": missing_or_zero(F.col("vehicle_count"), codes.DEFAULT_VEHICLES),
            "is_holiday": F.col("is_holiday").cast("int"),
        }
    )
    past = {
        n: F.coalesce(F.col(n), F.col("avg_speed_kmh")) if n in requests.columns else F.col("avg_speed_kmh")
        for n in ("speed_lag1h", "speed_lag24h", "speed_rolling3h")
    }
    return calendar_columns(filled).withColumns(past)


def score(
    requests: DataFrame,
    model: PipelineModel,
    features: Sequence[str] = codes.MODEL_FEATURES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Level, label, colour, confidence, probabilities, speed and advice.

    Every request comes back. One that breaks a rule has its messages in
    ``error`` and no prediction; it never stops the others.
    """
    checked = request_errors(with_request_defaults(requests))
    ready = request_features(checked).withColumns(
        {f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features}
    )
    ok = F.col("valid")
    level = F.col("prediction").cast("int")
    odds = F.transform(vector_to_array("probability"), lambda p: round_half_even(p, 3))
    names = F.array(*[F.lit(codes.LEVEL_LABELS[k]) for k in codes.LEVELS])
    names = F.slice(names, F.lit(1), F.size(odds))

    def given(value):
        return F.when(ok, value)

    return model.transform(ready).select(
        "segment_id",
        *carry,
        given(level).alias("congestion_level"),
        given(codes.level_label(level)).alias("congestion_label"),
        given(codes.level_color(level)).alias("congestion_color"),
        given(round_half_even(F.array_max(vector_to_array("probability")), 3)).alias("confidence"),
        given(F.map_from_arrays(names, odds)).alias("probabilities"),
        given(codes.level_speed_estimate(level)).alias("estimated_speed_kmh"),
        given(codes.level_recommendation(level)).alias("recommendation"),
        F.when(~ok, F.array_join("errors", "; ")).alias("error"),
    )


INPUTS = [
    "segment_id", "hour", "day_of_week", "month", "is_holiday",
    "weather_condition", "avg_speed_kmh", "vehicle_count", "lanes",
]


def _packed(requests: DataFrame) -> DataFrame:
    inputs = [c for c in INPUTS if c in requests.columns]
    return requests.withColumn("input_features", F.to_json(F.struct(*inputs)))


def prediction_rows(
    requests: DataFrame,
    model: PipelineModel,
    target: str = "recorded_at",
    model_version: str = "v1.0",
    predicted_at=None,
) -> DataFrame:
    """Scored requests in the shape of the ``predictions`` table; ``refused_rows`` has the others."""
    packed = _packed(requests)
    scored = score(packed, model, carry=[target, "input_features"])
    now = F.current_timestamp() if predicted_at is None else F.lit(predicted_at)
    return scored.filter(F.col("error").isNull()).select(
        "segment_id",
        now.cast("timestamp").alias("predicted_at"),
        F.col(target).cast("timestamp").alias("target_datetime"),
        F.col("congestion_level").cast("smallint").alias("predicted_level"),
        F.col("confidence").cast("decimal(4,3)").alias("confidence_score"),
        F.lit(model_version).alias("model_version"),
        "input_features",
    )


def refused_rows(requests: DataFrame, target: str = "recorded_at", carry: Sequence[str] = ()) -> DataFrame:
    """The quarantine beside ``prediction_rows``: requests that break a rule, with their messages and what they asked.

    Every request is in one of the two tables. The rules need no model, so a
    load can write this one first.
    """
    checked = request_errors(with_request_defaults(_packed(requests))).filter(~F.col("valid"))
    return checked.select(
        "segment_id",
        *carry,
        F.col(target).cast("timestamp").alias("target_datetime"),
        F.array_join("errors", "; ").alias("error"),
        "input_features",
    )
