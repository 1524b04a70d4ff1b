"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: A table up to this size is sent to every executor; its size is always measured first.
BROADCAST_BYTES = 16 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, for clusters where it isn't installed."""
    context = spark.sparkContext
    if not getattr(context, "_flowgauge_shipped", False):
        root = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="flowgauge-package-")  # Spark's own file server hands it out
        context.addPyFile(shutil.make_archive(f"{folder}/flowgauge", "zip", root.parent, root.name))
        context._flowgauge_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text itself, and the empty text for NULL."""
    return F.coalesce(F.col(name), F.lit(""))


def text_bytes(name: str = "text") -> Column:
    """UTF-8 bytes of a text; NULL counts as empty."""
    return whole_text(name).cast("binary")


def values(column: pa.Array, step: int = 256) -> Iterator:
    """The values of an Arrow column as Python objects, of which few exist at a time."""
    for at in range(0, len(column), step):
        yield from column.slice(at, step).to_pylist()


def per_row(df: DataFrame, work: Callable[..., tuple], schema: str, keep: list[str]) -> DataFrame:
    """``work(*values) -> tuple`` on every row, in Arrow batches of bounded bytes.

    The result holds the columns ``keep`` as they are, then those of
    ``schema``. ``work`` gets the columns of ``df`` that are not kept, in order.
    """
    given = [c for c in df.columns if c not in keep]
    out_types = to_arrow_schema(T.StructType.fromDDL(schema))
    whole = T.StructType([df.schema[c] for c in keep] + T.StructType.fromDDL(schema).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = zip(*(values(batch.column(batch.schema.get_field_index(c))) for c in given))
            out = zip(*(work(*row) for row in rows))
            made = [pa.array(x, type=f.type) for x, f in zip(out, out_types)]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(kept + made, names=keep + out_types.names)

    return df.mapInArrow(run, whole)


def text_key(name: str = "text") -> Column:
    """A hash of the text; with the doc_id it names a row, also where ids are missing or repeated."""
    return F.xxhash64(whole_text(name))


def without(docs: DataFrame, out: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose (doc_id, text_key) is not in ``out``; NULL equals NULL, and all columns stay as they are.

    ``out`` grows with the corpus, so it is merged at every size.
    """
    same_id = F.col("_docs.doc_id").eqNullSafe(F.col("_out.doc_id"))
    same_text = text_key("_docs.text") == F.col("_out.text_key")
    named = out.select("doc_id", "text_key").hint("merge").alias("_out")
    return docs.alias("_docs").join(named, same_id & same_text, "left_anti")


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its measured rows fit ``BROADCAST_BYTES``.

    A larger one is left to Spark, which then joins by a shuffle.
    """
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
