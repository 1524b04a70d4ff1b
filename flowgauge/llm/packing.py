"""Documents as pieces of tokens, packed into sequences of a fixed length.

The pieces' lengths are counted by Spark. The histogram has no more entries
than a sequence has tokens, so the configuration program (``configurations``)
is solved on the driver whatever the size of the corpus. Each configuration
gets a run of sequence numbers. A piece then needs only its rank among the
pieces of its length to find its place. Ranks are taken within small buckets
and moved up by the buckets before, so a length that a third of all pieces
share is not ranked in one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import small_side, text_bytes, values
from flowgauge.llm.configurations import Configuration, pack
from flowgauge.llm.tokens import word_ids
from flowgauge.session import settle

CAPACITY = 4096
#: Appended to every document.
END_ID = 1
#: Pieces of one length that are ranked in one task.
RANKED = 100_000
_BATCH = 8192


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document, and ``ids`` (little-endian 32 bits) if wanted."""
    end = END_ID.to_bytes(4, "little")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * with_ids

    def rows(of: list, source: pa.Array) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*of), kinds)]
        return pa.RecordBatch.from_arrays([source.take(columns[0]), *columns[1:]], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer).ids
        for batch in batches:
            made = []
            for i, text in enumerate(values(batch.column(1))):
                ids = encode(text) + end
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    made.append((i, n, at // 4, len(part) // 4, zlib.crc32(part), part)[: len(names)])
                if len(made) >= _BATCH:
                    yield rows(made, batch.column(0))
                    made = []
            if made:
                yield rows(made, batch.column(0))

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return docs.select("doc_id", text_bytes()).mapInArrow(run, schema)


def ranked(found: DataFrame, histogram: dict[int, int], most: int = RANKED) -> DataFrame:
    """``found`` plus ``rank``: 0, 1, ... within each length."""
    buckets = max(1, -(-2 * max(histogram.values(), default=1) // most))
    found = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    found = found.withColumn("rank", F.row_number().over(within).cast("bigint") - 1)
    if buckets == 1:
        return found.drop("bucket")
    counts = found.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = settle(counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    found = found.join(small_side(before, before.count(), 24), ["length", "bucket"])
    return found.withColumn("rank", F.col("rank") + F.col("before")).drop("bucket", "before")


def slots(packed: list[tuple[Configuration, int]]) -> dict[str, np.ndarray]:
    """For every length the runs of its ranks: (length, first rank) -> sequence, copies and offset, sorted."""
    rows, base, used = [], 0, {}
    for configuration, times in packed:
        offset = 0
        for length, copies in configuration:
            first = used.get(length, 0)
            rows.append((length, first, base, copies, offset))
            used[length] = first + copies * times
            offset += length * copies
        base += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "base", "copies", "offset"), table.T))


def place(found: DataFrame, packed: list[tuple[Configuration, int]]) -> DataFrame:
    """``found`` (with length and rank) plus sequence_id and offset."""
    at = found.sparkSession.sparkContext.broadcast(slots(packed))
    names, kinds = found.columns, found.dtypes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = at.value
        edges = np.searchsorted(table["length"], np.arange(table["length"].max(initial=0) + 2))
        of_length = {n: slice(a, b) for n, (a, b) in enumerate(pairwise(edges)) if b > a}
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy()
            rank = batch.column(names.index("rank")).to_numpy()
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for n in np.unique(length):
                mine, own = np.flatnonzero(length == n), of_length[int(n)]
                row = own.start + np.searchsorted(table["first"][own], rank[mine], side="right") - 1
                which = rank[mine] - table["first"][row]
                sequence[mine] = table["base"][row] + which // table["copies"][row]
                offset[mine] = table["offset"][row] + which % table["copies"][row] * n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    schema = ", ".join(f"`{c}` {t}" for c, t in kinds)
    return found.mapInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def best_fit_packing(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    A document's ids are those of its whole text (NULL counts as empty) and
    one ``END_ID``, so every document has a piece. Only documents above the
    capacity are cut. Sequences are numbered from 0 and filled from offset 0
    without gaps. Repeated rows and rows without a doc_id are packed like any
    other. Other columns are not read. ``tokenizer`` is the path of a
    vocabulary file whose tokenizer drops white space.
    """
    found = settle(pieces(docs, tokenizer, capacity, with_ids))
    counted = found.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counted.collect()}  # ``capacity`` rows at most
    return place(ranked(found, histogram), pack(histogram, capacity)).drop("rank")
