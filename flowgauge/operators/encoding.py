"""Named one-hot columns and the model's feature vector."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.functions.codes import MODEL_FEATURES
from flowgauge.operators.slices import running_offsets
from flowgauge.session import settle

MAX_CATEGORIES = 1000


def in_order(df: DataFrame, column: str, values: Iterable[str]) -> list[str]:
    """Categories sorted as the column's own type would be."""
    whole = dict(df.dtypes)[column] in ("tinyint", "smallint", "int", "bigint")
    return sorted(values, key=int) if whole else sorted(values)


def fit_categories(
    df: DataFrame, columns: Sequence[str], max_categories: int = MAX_CATEGORIES
) -> dict[str, list[str]]:
    """Sorted categories of each column, all found in one pass.

    Every category becomes a column, so a column with more than
    ``max_categories`` is refused; ``sparse_one_hot`` takes any number.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
    )
    found = df.select(F.inline(pairs)).dropna().distinct()
    rows = found.limit(len(columns) * max_categories + 1).collect()
    out = {}
    for c in columns:
        out[c] = in_order(df, c, [r["v"] for r in rows if r["c"] == c])
        if len(out[c]) > max_categories:
            raise ValueError(f"{c} has more than {max_categories} categories")
    return out


def one_hot(
    categories: Mapping[str, Sequence], prefixes: Mapping[str, str], drop_first: bool = True
) -> dict[str, Column]:
    """0/1 columns ``<prefix>_<category>``; the first category has none.

    A NULL or unseen value is 0 everywhere.
    """
    out = {}
    for name, values in categories.items():
        for value in values[1 if drop_first else 0:]:
            hit = F.col(name).cast("string") == F.lit(str(value))
            out[f"{prefixes[name]}_{value}"] = F.coalesce(hit, F.lit(False)).cast("int")
    return out


def category_positions(df: DataFrame, column: str) -> DataFrame:
    """(column, position) of every category in the column's own order, from 0; any number of categories."""
    values = df.select(column).dropna().distinct().withColumn("_one", F.lit(1))
    placed = running_offsets(values, [column], "_one", "position")
    return settle(placed.select(column, F.col("position").cast("bigint")))


def sparse_one_hot(
    df: DataFrame, positions: DataFrame, column: str, out: str, drop_first: bool = True
) -> DataFrame:
    """``df`` with a sparse vector of 0 and 1 over the categories of ``positions``.

    The vector has one place per category, but none for the first with
    ``drop_first``; NULL and unseen values are 0 everywhere. It goes into the
    feature vector as it is: ``assembler([*MODEL_FEATURES, out])``.
    """
    skipped = 1 if drop_first else 0
    size = positions.count() - skipped
    if size < 1:
        raise ValueError(f"{column} has no category to encode")
    table = positions.select(F.col(column).alias("_value"), (F.col("position") - skipped).alias("_place"))
    placed = df.join(table, F.col(column) == F.col("_value"), "left")
    # what has no place counts as the one place beyond the last, which the encoder drops
    at = F.when(F.col("_place") >= 0, F.col("_place")).otherwise(size).cast("double")
    known = df.sparkSession.range(size - 1, size).select(F.col("id").cast("double").alias("_at"))
    encoder = OneHotEncoder(inputCol="_at", outputCol=out, handleInvalid="keep", dropLast=True).fit(known)
    return encoder.transform(placed.withColumn("_at", at)).select(*df.columns, out)


def vector_places(vector: str) -> tuple[Column, Column]:
    """Length of a sparse 0/1 vector, and the place of its first one from 1 (0: none).

    Both are read from the stored places, so a row costs what it holds and not
    the vector's length, as an array of it would.
    """
    stored = F.unwrap_udt(F.col(vector))
    nth = F.array_position(stored["values"], F.lit(1.0)).cast("int")
    place = F.coalesce(F.get(stored["indices"], nth - 1) + 1, F.lit(0))
    return stored["size"].cast("bigint"), place.cast("bigint")


def assembler(features: Sequence[str] = MODEL_FEATURES, out: str = "features") -> VectorAssembler:
    """Feature vector by column name; a NULL feature is an error."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")
