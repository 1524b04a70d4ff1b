"""Lines that many documents repeat are dropped from all of them but one.

Pass 1 explodes each text into its normalised lines, hashes them to 128 bits
and counts the distinct documents per hash. The count runs in two steps (first
per line and document, then per line), so a line that a third of all documents
share is combined before it meets in one task. Pass 2 joins the lines with the
frequent ones, gives each document the list of its own lines that go, and puts
the rest together again by position.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import per_row, text_bytes, values
from flowgauge.session import settle

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: bytes) -> bytes:
    """A line without ASCII white space at its ends and with A-Z lowered."""
    return line.strip().lower()


def line_hash(line: bytes, min_chars: int) -> tuple[int, int] | None:
    """128 bits of the line's key in two signed numbers; None if it has fewer than ``min_chars`` code points."""
    key = line_key(line)
    if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8")) < min_chars):
        return None
    digest = xxhash.xxh3_128_digest(key)
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, h1, h2): each long line of a document once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, first, h1, h2 = batch.column(0), [], [], []
            for i, text in enumerate(values(batch.column(1))):
                found = {line_hash(line, min_chars) for line in text.split(b"\n")} - {None}
                first += [i] * len(found)
                h1 += [a for a, _ in found]
                h2 += [b for _, b in found]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(first, pa.int64())), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())],
                names=["doc_id", "h1", "h2"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", text_bytes()).mapInArrow(run, f"doc_id {kind}, h1 bigint, h2 bigint")


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(h1, h2, keeper): lines in at least ``min_docs`` documents, and the largest doc_id that holds each."""
    counted = lines.groupBy("h1", "h2").agg(
        F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keeper")
    )
    return counted.filter(F.col("n") >= min_docs).drop("n")


def lines_to_drop(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, gone): for each document that loses lines, the 128-bit hashes of these."""
    lines = settle(long_lines(docs, min_chars))
    often = settle(frequent_lines(lines, min_docs))
    gone = lines.join(often, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return settle(gone.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("gone")))


def _kept_lines(docs: DataFrame, gone: DataFrame, min_chars: int) -> DataFrame:
    """Columns of ``docs`` by position (c0, c1, ...), then n_lines, n_dropped and kept."""
    at = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    gone = gone.hint("merge")  # it grows with the corpus: one plan for every size
    both = docs.toDF(*at.values()).join(gone, F.col(at["doc_id"]).eqNullSafe(F.col("doc_id")), "left")
    both = both.withColumn("whole", text_bytes(at["text"])).drop("doc_id", at["text"])

    def work(gone, text):
        lines = text.split(b"\n")
        if not gone:
            return len(lines), 0, text.decode("utf-8")
        out = {(g["h1"], g["h2"]) for g in gone}
        kept = [line for line in lines if line_hash(line, min_chars) not in out]
        return len(lines), len(lines) - len(kept), b"\n".join(kept).decode("utf-8")

    keep = [c for name, c in at.items() if name != "text"]
    return per_row(both, work, "n_lines bigint, n_dropped bigint, kept string", keep)


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines (before), n_dropped, text (what stays).

    NULL and empty texts are one empty line. ``text`` is joined by line feeds,
    and empty if nothing stays. A line counts once per document, and repeated
    rows of one doc_id are one document. A NULL doc_id is no document: it
    doesn't count, and it keeps no frequent line. Other columns are not read.
    """
    gone = lines_to_drop(docs, min_chars, min_docs)
    kept = _kept_lines(docs.select("doc_id", "text"), gone, min_chars)
    return kept.select(F.col("c0").alias("doc_id"), "n_lines", "n_dropped", F.col("kept").alias("text"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the same columns and rows, and in ``text`` only the lines that stay."""
    gone = lines_to_drop(docs, min_chars, min_docs)
    kept = _kept_lines(docs, gone, min_chars)
    back = ["kept" if name == "text" else f"c{i}" for i, name in enumerate(docs.columns)]
    return kept.select(*[F.col(c).alias(name) for c, name in zip(back, docs.columns)])
