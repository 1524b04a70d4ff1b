"""Exact duplicates by a two-pass Bloom filter, in DataFrame functions only.

Pass 1 gives every row two slots of a bit table, from two hashes of its text,
and counts the rows per slot. Only slots hit at least twice are kept, as words
of 64 bits: a row can have a copy only if both its slots are there.

Pass 2 tests every row against these bits. Rows that fail have no copy and go
straight through; only the others are shuffled by their full SHA-256 and
compared. The bits decide the amount of work, never the result.

Slots are counted, not collected, and a text that fills a third of the table
is combined to one row per task before it is sent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import small_side, whole_text
from flowgauge.session import settle

#: Bits of the table per row and hash: a row without a copy is tested in vain with (1 / 16)^2.
BITS_PER_ROW = 16
_WORD_BYTES = 16


def text_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, h1, h2): SHA-256 of the text (NULL: empty) and two independent 64-bit hashes."""
    text = whole_text()
    return docs.select(
        "doc_id",
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.xxhash64(text).alias("h1"),
        F.xxhash64(F.lit(1), text).alias("h2"),
    )


def repeated_bits(rows: DataFrame, name: str, bits: int) -> DataFrame:
    """The bit table of one hash: (word, mask) with the bits of the slots that two or more rows hit."""
    slot = F.pmod(F.col(name), F.lit(bits)).alias("slot")
    hit = rows.groupBy(slot).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    return hit.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("mask"))


def possibly_repeated(rows: DataFrame, bits: int) -> DataFrame:
    """``rows`` plus ``maybe``: whether both bit tables hold the row's slot."""
    for name in ("h1", "h2"):
        table = settle(repeated_bits(rows, name, bits))
        table = small_side(table, table.count(), _WORD_BYTES)
        slot = F.pmod(F.col(name), F.lit(bits))
        named = table.select(F.col("word").alias(f"{name}_word"), F.col("mask").alias(f"{name}_mask"))
        rows = rows.join(named, F.shiftright(slot, 6) == F.col(f"{name}_word"), "left")
        hit = F.getbit(F.coalesce(f"{name}_mask", F.lit(0).cast("bigint")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1
        rows = rows.withColumn(f"{name}_hit", hit).drop(f"{name}_word", f"{name}_mask")
    return rows.withColumn("maybe", F.col("h1_hit") & F.col("h2_hit")).drop("h1_hit", "h2_hit")


def exact_duplicates(docs: DataFrame, bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical; NULL counts as empty. The row with the
    largest doc_id stays. Repeated rows (same text, same doc_id) each count in
    ``group_size`` and get equal answers. A row without a doc_id stays only if
    its whole group has none. Other columns are not read.
    """
    rows = settle(text_digests(docs))
    bits = 1 << max(10, (bits_per_row * rows.count() - 1).bit_length())
    tested = settle(possibly_repeated(rows, bits).drop("h1", "h2"))

    alone = tested.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "digest"
    )
    checked = tested.filter("maybe")
    groups = checked.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    met = checked.select("doc_id", "digest").join(groups, "digest")
    return (
        alone.unionByName(met)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
    )
