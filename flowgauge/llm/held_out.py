"""Which documents a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def fold(name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; 0 for a row without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(FOLDS)), F.lit(0)).cast("int")


def is_held_out(name: str = "doc_id") -> Column:
    """Documents of fold 0 are never learned from."""
    return fold(name) == 0


def training_labels(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, fold, y) of the labels that may be learned from; NULL labels are left out."""
    found = labels.select("doc_id", fold().alias("fold"), F.col(name).cast("double").alias("y"))
    return found.filter("fold > 0 AND y IS NOT NULL")
