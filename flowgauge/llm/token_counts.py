"""Token counts of documents in flat token files, found by their separators alone.

A flat token file is nothing but ids, one document after the other, each
closed by an end-of-document id. Here it is stored as numbered blocks of a
fixed number of little-endian 16- or 32-bit ids, so that any reader can split
it; blocks are cut wherever they are full, mostly inside a document, and no
index says where documents begin.

Counting looks for the separator in each block at once (one vectorised
comparison), and keeps one row per separator: its number and place inside the
block. A prefix scan over the blocks' totals then gives every separator its
number and place in the file, and the distance to the one before is the
document's length, however many blocks lie between.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flowgauge.llm.common import text_bytes, values
from flowgauge.session import settle

#: End of document: the first id that the vocabulary leaves free.
SEPARATOR = 50256
#: GPT-2's rule for cutting text before the byte pairs are merged.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BLOCK_IDS = 1 << 16
_OPEN: dict[str, tiktoken.Encoding] = {}


def encoding(path: str) -> tiktoken.Encoding:
    """The byte-pair vocabulary of ``path``, opened once per Python worker."""
    if path not in _OPEN:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
        _OPEN[path] = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _OPEN[path]


def write_flat(docs: DataFrame, ranks: str, separator: int = SEPARATOR, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Tokenise ``docs`` into flat files: (file, block, ids, begun).

    Every input partition is one file. ``begun`` lists the doc_id of each
    document whose first id (the separator, if it is empty) lies in the block:
    the names for what is counted, not used to count.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_schema(T.StructType([docs.schema["doc_id"]])).field(0).type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, file = encoding(ranks).encode_ordinary, TaskContext.get().partitionId()
        full, held, names, block = 2 * block_ids, bytearray(), [], 0
        id_kind = pa.list_(id_type)

        def flush() -> pa.RecordBatch:
            mine = [n for at, n in names if at < full]
            names[:] = [(at - full, n) for at, n in names if at >= full]
            columns = [[file], [block], [bytes(held[:full])], [mine]]
            del held[:full]
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary(), id_kind))]
            return pa.RecordBatch.from_arrays(arrays, names=["file", "block", "ids", "begun"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), values(batch.column(1))):
                names.append((len(held), doc_id))
                held += np.array([*encode(text.decode("utf-8")), separator], dtype="<u2").tobytes()
                while len(held) >= full:
                    yield flush()
                    block += 1
        if held:
            yield flush()

    if separator >= 1 << 16:
        raise ValueError("blocks hold 16-bit ids")
    schema = f"file int, block bigint, ids binary, begun array<{kind}>"
    return docs.select("doc_id", text_bytes()).mapInArrow(run, schema)


def block_separators(blocks: DataFrame, separator: int = SEPARATOR, id_bytes: int = 2) -> DataFrame:
    """(file, block, n_ids, at): the places of the separators inside each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for raw in batch.column(2):
                ids = np.frombuffer(raw.as_buffer(), dtype=f"<u{id_bytes}")
                found.append(np.flatnonzero(ids == separator))
                sizes.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["file", "block", "n_ids", "at"],
            )

    return blocks.select("file", "block", "ids").mapInArrow(run, "file int, block bigint, n_ids bigint, at array<bigint>")


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, id_bytes: int = 2) -> DataFrame:
    """(file, ordinal, n_tokens) of every document in flat files given as blocks (file, block, ids).

    Separators aren't counted. Ids after a file's last separator are a last
    document without one. Empty blocks and files without ids give nothing.
    """
    found = settle(block_separators(blocks, separator, id_bytes).filter("n_ids > 0"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    file_end = Window.partitionBy("file").orderBy(F.col("block").desc())
    totals = found.select("file", "block", "n_ids", F.size("at").alias("n"), F.array_max("at").alias("last"))
    start = F.coalesce(F.sum("n_ids").over(before), F.lit(0))
    scanned = (
        totals.withColumn("start", start)
        .withColumn("n_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .withColumn("last_end", F.col("start") + F.col("last"))
        .withColumn("previous", F.coalesce(F.max("last_end").over(before), F.lit(-1)))
        .withColumn("final", F.row_number().over(file_end) == 1)
        .drop("n", "last", "last_end", "n_ids")
    )
    placed = found.join(scanned, ["file", "block"])
    # an open last document ends at the file's end, as if a separator stood there
    ends_open = F.col("final") & (F.coalesce(F.array_max("at"), F.lit(-1)) < F.col("n_ids") - 1)
    at = F.when(ends_open, F.concat("at", F.array("n_ids"))).otherwise(F.col("at"))
    ends = placed.select("file", "start", "n_before", "previous", at.alias("at"))
    shifted = F.concat(F.array(F.col("previous") - F.col("start")), F.col("at"))
    each = ends.select("file", "n_before", F.posexplode(F.arrays_zip(F.col("at").alias("end"), shifted.alias("begin"))))
    each = each.filter("col.end IS NOT NULL")
    return each.select(
        "file",
        (F.col("n_before") + F.col("pos")).alias("ordinal"),
        (F.col("col.end") - F.col("col.begin") - 1).alias("n_tokens"),
    )


def document_names(blocks: DataFrame) -> DataFrame:
    """(file, ordinal, doc_id) from the documents that begin in each block."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = blocks.select("file", "block", F.size("begun").alias("n"))
    starts = counts.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"))
    named = blocks.select("file", "block", "begun").join(starts, ["file", "block"])
    named = named.select("file", "n_before", F.posexplode("begun").alias("pos", "doc_id"))
    return named.select("file", (F.col("n_before") + F.col("pos")).alias("ordinal"), "doc_id")


def token_counts(docs: DataFrame, ranks: str, separator: int = SEPARATOR, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens (without the separator), file, ordinal.

    The documents are written to flat token files first and counted there by
    the separator scan. NULL and empty texts have 0 tokens. Text that spells a
    separator is ordinary text. Repeated rows and rows without a doc_id are
    documents like any other; other columns are not read. ``ranks`` is the
    path of a vocabulary file.
    """
    blocks = settle(write_flat(docs, ranks, separator, block_ids))
    counted = count_tokens(blocks, separator)
    return document_names(blocks).join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
