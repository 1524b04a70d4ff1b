"""Classification metrics from label/prediction pairs.

Everything derives from the confusion counts, which are combined before the
shuffle and hold at most classes x classes rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.codes import LEVELS
from flowgauge.functions.numeric import safe_ratio


def confusion(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    labels: Sequence[int] = LEVELS,
) -> DataFrame:
    """Row count of every (label, prediction) cell, empty cells included."""
    seen = df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )
    cells = df.sparkSession.createDataFrame(
        [(a, b, 0) for a in labels for b in labels], "label int, prediction int, n bigint"
    )
    return seen.unionByName(cells).groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def confusion_array(cells: DataFrame) -> DataFrame:
    """The matrix as one row: an array of rows in label order."""
    lines = cells.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("prediction", "n"))), lambda c: c["n"]).alias("line")
    )
    return lines.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("label", "line"))), lambda c: c["line"]).alias(
            "confusion_matrix"
        )
    )


def class_scores(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each class; 0 where undefined.

    Classes that occur neither as label nor as prediction are left out.
    """
    sides = F.array(
        F.struct(F.col("label").alias("c"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("guessed")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("guessed")),
    )
    hit = F.when((F.col("label") == F.col("prediction")) & (F.col("actual") > 0), F.col("n")).otherwise(0)
    sums = (
        cells.select("label", "prediction", "n", F.inline(sides))
        .groupBy(F.col("c").alias("label"))
        .agg(
            F.sum(hit).alias("hits"),
            F.sum("actual").alias("support"),
            F.sum("guessed").alias("guessed"),
        )
    )
    both = F.col("support") + F.col("guessed")
    return sums.filter(both > 0).select(
        "label",
        "hits",
        safe_ratio(F.col("hits"), F.col("guessed")).alias("precision"),
        safe_ratio(F.col("hits"), F.col("support")).alias("recall"),
        safe_ratio(F.lit(2) * F.col("hits"), both).alias("f1"),
        "support",
    )


def _weighted(name: str):
    return safe_ratio(F.sum(F.col(name) * F.col("support")), F.sum("support"))


def class_report(cells: DataFrame) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg``."""
    scores = class_scores(cells)
    names = ("precision", "recall", "f1")
    per_class = scores.select(F.col("label").cast("string").alias("class"), *names, "support")
    totals = scores.agg(
        safe_ratio(F.sum("hits"), F.sum("support")).alias("acc"),
        *[F.avg(n).alias(f"m_{n}") for n in names],
        *[_weighted(n).alias(f"w_{n}") for n in names],
        F.sum("support").alias("support"),
    )

    def line(title: str, columns):
        cells_ = [c.alias(n) for n, c in zip(names, columns)]
        return F.struct(F.lit(title).alias("class"), *cells_, F.col("support"))

    lines = F.array(
        line("accuracy", [F.col("acc")] * 3),
        line("macro avg", [F.col(f"m_{n}") for n in names]),
        line("weighted avg", [F.col(f"w_{n}") for n in names]),
    )
    return per_class.unionByName(totals.select(F.inline(lines)))


def overall_scores(cells: DataFrame) -> DataFrame:
    """One row: accuracy, weighted F1, macro F1 and the number of rows."""
    scores = class_scores(cells)
    return scores.agg(
        safe_ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        _weighted("f1").alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"),
        F.sum("support").alias("n"),
    )


def score_summary(scores: DataFrame, value: str = "score") -> DataFrame:
    """Mean and population deviation of cross-validation scores."""
    return scores.agg(
        F.avg(value).alias("cv_mean"),
        F.stddev_pop(value).alias("cv_std"),
        F.count(value).alias("n_folds"),
    )
