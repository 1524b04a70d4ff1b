"""SimHash near-duplicates: pigeonhole blocks, then the Hamming distance.

A document's fingerprint has bit ``i`` set if bit ``i`` is set in more than
half of the hashes of its word shingles. Two fingerprints that differ in at
most ``d`` of 64 bits agree on at least three of ``d + 3`` blocks, so they meet
in the table of some choice of three blocks. Every distinct fingerprint goes
to each table once.

Blocks with few fingerprints are joined with themselves and verified. A block
that holds many (a large group of near copies) is not paired: there each
fingerprint is filed under itself and its 64 neighbours at one bit. Two
fingerprints share such a key if and only if they differ in at most two bits,
and a key can hold no more than 65 fingerprints, so the work stays linear and
no link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import per_row, text_bytes, text_key, without
from flowgauge.llm.components import components
from flowgauge.session import settle

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Blocks with more fingerprints are searched by one-bit neighbours instead of pairs.
PAIRED_BLOCK = 32
_SPARE = 3
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint of a UTF-8 text as a signed 64-bit number.

    A-Z are lowered, words are runs without ASCII white space. A text of fewer
    words than a shingle is one shingle; a text without words gives zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, _CHUNK):
        part = words[start : start + _CHUNK + k - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(k)), strict=False))
        hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_key, fp) of every row; NULL text counts as empty."""

    def work(text):
        return (fingerprint(text, shingle_words),)

    rows = docs.select("doc_id", text_key().alias("text_key"), text_bytes().alias("text"))
    return per_row(rows, work, "fp bigint", ["doc_id", "text_key"])


def _masks(max_bits: int) -> list[int]:
    """Every choice of three out of ``max_bits + 3`` blocks, as signed masks."""
    edges = np.linspace(0, 64, max_bits + _SPARE + 1).round().astype(int)
    blocks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(edges, edges[1:])]
    masks = [sum(chosen) for chosen in combinations(blocks, _SPARE)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _signed(bit: int) -> int:
    return -(1 << 63) if bit == 63 else 1 << bit


def links(fps: DataFrame, max_bits: int = MAX_BITS, paired_block: int = PAIRED_BLOCK) -> DataFrame:
    """Distinct fingerprints ``fp`` -> (a, b), linking exactly those that differ in at most ``max_bits``.

    Not every linked pair is listed: inside a crowded key the pairs form a
    star, which connects the same fingerprints.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError("max_bits is 0, 1 or 2")
    if max_bits == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter(F.lit(False))
    keys = [
        F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(_masks(max_bits))
    ]
    filed = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.t", "k.key")
    sizes = filed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = settle(filed.join(sizes, ["t", "key"]))

    few = shared.filter(F.col("n") <= paired_block)
    left, right = few.select("t", "key", F.col("fp").alias("a")), few.select("t", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    paired = left.join(right, ["t", "key"]).filter((F.col("a") > F.col("b")) & near).select("a", "b")

    crowd = shared.filter(F.col("n") > paired_block).select("fp").distinct()
    if max_bits == 2:  # equal after one flipped bit on either side
        beside = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit(_signed(i))) for i in range(64)]
    else:  # equal but for one bit, which is cleared
        beside = [
            F.struct(F.lit(i), F.col("fp").bitwiseAND(F.lit(~_signed(i)))) for i in range(64)
        ]
    keyed = crowd.select("fp", F.explode(F.array(*beside)).alias("key"))
    stars = keyed.groupBy("key").agg(F.collect_set("fp").alias("all")).filter(F.size("all") > 1)
    stars = stars.select(F.array_min("all").alias("b"), F.explode("all").alias("a"))
    return paired.unionByName(stars.filter((F.col("a") > F.col("b")) & near).select("a", "b")).distinct()


def near_duplicates(
    docs: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    paired_block: int = PAIRED_BLOCK,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id, text_key.

    ``component_id`` is the smallest doc_id that is reachable by links. NULL
    texts count as empty, and all texts without words are copies of each
    other. Repeated rows give repeated rows; rows without a doc_id get their
    group's number, or NULL if nobody in the group has one. Other columns of
    ``docs`` are not read.
    """
    own = settle(fingerprints(docs, shingle_words))
    distinct = settle(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("fp"), max_bits, paired_block))
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "fp"))
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = grouped.join(ids, "root").select("fp", "component_id")
    return own.join(of_print, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "text_key"
    )


def keep_one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of their group, all columns as they are.

    Repeated rows with that doc_id are one document and stay together. Rows
    without a doc_id go if any document of their group has one.
    """
    found = near_duplicates(docs, **settings)
    out = found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "text_key").distinct()
    return without(docs, settle(out))
