"""Random-forest training, tuning, cross-validation and evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from flowgauge.functions import codes
from flowgauge.functions.numeric import round_half_even
from flowgauge.operators import metrics
from flowgauge.operators.encoding import assembler
from flowgauge.operators.scaling import fit_scaling, scaler_stage
from flowgauge.operators.slices import join_groups
from flowgauge.operators.splits import stratified_folds
from flowgauge.session import settle

LABEL = "congestion_level"
WEIGHT = "class_weight"
DEEPEST = 30  # Spark's limit, used where a tree may grow without bound

FOREST = {"numTrees": 200, "maxDepth": 20, "minInstancesPerNode": 2, "seed": 42}
QUICK_GRID = {
    "numTrees": [100, 200],
    "maxDepth": [15, 20, DEEPEST],
    "minInstancesPerNode": [1, 2],
}
FULL_GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [10, 20, DEEPEST],
    "minInstancesPerNode": [1, 2, 4],
}


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # one row per class is left here
    rows = F.sum("n").over(everything).cast("double")
    classes = F.count(F.lit(1)).over(everything)
    return counts.withColumn("weight", rows / (classes * F.col("n")))


def forest_pipeline(
    train: DataFrame,
    features: Sequence[str] = codes.MODEL_FEATURES,
    label: str = LABEL,
    **forest,
) -> Pipeline:
    """Scaling fitted on ``train``, feature assembly, weighted forest."""
    params = fit_scaling(train, features)
    model = RandomForestClassifier(
        labelCol=label,
        featuresCol="features",
        weightCol=WEIGHT,
        cacheNodeIds=True,
        **{**FOREST, **forest},
    )
    return Pipeline(
        stages=[scaler_stage(params), assembler([f"{f}_z" for f in features]), model]
    )


def with_weights(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Each row with the balanced weight of its class, joined from the table of classes."""
    weights = settle(class_weights(train, label).select(label, F.col("weight").alias(WEIGHT)))
    return join_groups(train, weights, [label])


def train_forest(
    train: DataFrame,
    features: Sequence[str] = codes.MODEL_FEATURES,
    label: str = LABEL,
    **forest,
) -> PipelineModel:
    """Class-balanced random forest with its scaling."""
    weighted = with_weights(train, label)
    return forest_pipeline(weighted, features, label, **forest).fit(weighted)


def weighted_f1(label: str = LABEL) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="f1")


@dataclass
class Search:
    """What a grid search tried, its mean score each, and the best model fitted on all rows."""

    tried: list[dict]
    avgMetrics: list[float]
    bestModel: PipelineModel

    @property
    def best(self) -> dict:
        return self.tried[max(range(len(self.tried)), key=self.avgMetrics.__getitem__)]


def fold_scores(
    folded: DataFrame, folds: int, features: Sequence[str], label: str, **forest
) -> list[float]:
    """Weighted F1 of each fold; scaling and class weights are learned from the other folds."""
    scores = []
    for fold in range(folds):
        model = train_forest(folded.filter(F.col("fold") != fold), features, label, **forest)
        held = model.transform(folded.filter(F.col("fold") == fold))
        scores.append(weighted_f1(label).evaluate(held))
    return scores


def tune_forest(
    train: DataFrame,
    quick: bool = True,
    *,
    grid: Mapping[str, Sequence] | None = None,
    folds: int = 3,
    features: Sequence[str] = codes.MODEL_FEATURES,
    label: str = LABEL,
    parallelism: int = 2,
    **keys,
) -> Search:
    """Grid search by weighted F1 over stratified folds; of equal scores the first wins."""
    axes = grid or (QUICK_GRID if quick else FULL_GRID)
    tried = [dict(zip(axes, values)) for values in product(*axes.values())]
    folded = stratified_folds(train, folds, label, **keys).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            runs = [pool.submit(fold_scores, folded, folds, features, label, **t) for t in tried]
            means = [sum(run.result()) / folds for run in runs]
    finally:
        folded.unpersist()
    best = tried[max(range(len(tried)), key=means.__getitem__)]
    return Search(tried, means, train_forest(train, features, label, **best))


def cross_validate(
    train: DataFrame,
    folds: int = 5,
    features: Sequence[str] = codes.MODEL_FEATURES,
    label: str = LABEL,
    keys: Mapping[str, str] | None = None,
    **forest,
) -> DataFrame:
    """Weighted F1 of each stratified fold; scaling and weights are fitted inside the fold."""
    folded = stratified_folds(train, folds, label, **(keys or {}))
    folded = folded.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        scores = [*enumerate(fold_scores(folded, folds, features, label, **forest))]
    finally:
        folded.unpersist()
    return train.sparkSession.createDataFrame(scores, "fold int, score double")


def feature_importances(
    spark: SparkSession,
    model: PipelineModel,
    features: Sequence[str] = codes.MODEL_FEATURES,
    limit: int | None = 10,
) -> DataFrame:
    """Features by falling importance."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    table = spark.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double"
    )
    ordered = table.orderBy(F.col("importance").desc(), F.col("feature"))
    return ordered if limit is None else ordered.limit(limit)


def evaluate(
    model: PipelineModel,
    test: DataFrame,
    features: Sequence[str] = codes.MODEL_FEATURES,
    label: str = LABEL,
    trained_at: datetime | None = None,
) -> DataFrame:
    """The metrics record: one row, ready for the JSON sink."""
    predicted = model.transform(test).select(F.col(label).alias("label"), "prediction")
    cells = metrics.confusion(predicted)
    scores = metrics.overall_scores(cells)
    rounded = [
        round_half_even(F.col(n), 4).alias(n) for n in ("accuracy", "f1_weighted", "f1_macro")
    ]
    moment = (trained_at or datetime.now(timezone.utc)).isoformat()
    matrix = metrics.confusion_array(cells).select(F.lit(1).alias("_one"), "confusion_matrix")
    return (
        scores.select(F.lit(1).alias("_one"), *rounded)
        .join(matrix, "_one")
        .select(
            "accuracy",
            "f1_weighted",
            "f1_macro",
            "confusion_matrix",
            F.lit(moment).alias("trained_at"),
            F.lit("RandomForestClassifier").alias("model_type"),
            F.lit(len(features)).alias("n_features"),
            F.array(*[F.lit(f) for f in features]).alias("feature_names"),
        )
    )


def add_cv_scores(record: DataFrame, mean: float, std: float) -> DataFrame:
    return record.withColumns(
        {
            "cv_mean": round_half_even(F.lit(float(mean)), 4),
            "cv_std": round_half_even(F.lit(float(std)), 4),
        }
    )


def model_info(
    spark: SparkSession, model: PipelineModel | None, record: DataFrame | None = None
) -> DataFrame:
    """One row: loaded, model type, number of features, metrics as JSON."""
    forest = model.stages[-1] if model is not None else None
    info = spark.createDataFrame(
        [
            (
                model is not None,
                type(forest).__name__ if forest is not None else None,
                forest.numFeatures if forest is not None else None,
                forest.getNumTrees if forest is not None else None,
            )
        ],
        "loaded boolean, model_type string, n_features int, n_trees int",
    )
    if record is None:
        return info.withColumn("metrics", F.lit(None).cast("string"))
    text = record.limit(1).select(F.to_json(F.struct("*")).alias("metrics"))
    return info.withColumn("metrics", text.scalar())


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A saved model; a missing path is a ``FileNotFoundError``."""
    try:
        return PipelineModel.load(path)
    except Exception as e:
        if any(said in str(e) for said in ("does not exist", "PATH_NOT_FOUND", "Input path")):
            raise FileNotFoundError(f"no model at {path}; train it first") from e
        raise
