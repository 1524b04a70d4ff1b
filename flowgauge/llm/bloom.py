"""Bit tables of bounded size that tell Python tasks which hashes a table may hold."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A table has 32 bits for each hash as far as 2**27 (16 MB) go; a fuller table only lets more rows pass.
MOST_BITS = 27
LEAST_BITS = 13
_BITS_EACH = 32


@dataclass
class BitTable:
    """A Bloom filter over well-mixed 64-bit hashes; two slices of a hash are the places of its bits."""

    words: np.ndarray
    bits: int

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        """True for every hash that was put in, and seldom for others."""
        found = np.ones(len(hashes), dtype=bool)
        for shift in (0, self.bits):
            place = (hashes.view(np.uint64) >> np.uint64(shift)) & np.uint64((1 << self.bits) - 1)
            word = self.words[(place >> np.uint64(6)).astype(np.int64)]
            found &= (word >> (place & np.uint64(63))) & np.uint64(1) != 0
        return found


def bit_table(hashes: DataFrame, bits: int | None = None) -> BitTable:
    """The bit table of ``hashes`` (a written table with one column, ``h bigint``; NULLs are left out).

    Bits are set by an aggregation per 64-bit word, so the driver gets at most
    ``2**bits / 64`` words, however many hashes there are.
    """
    if bits is None:
        bits = min(max((hashes.count() * _BITS_EACH).bit_length(), LEAST_BITS), MOST_BITS)
    slices = [F.shiftrightunsigned("h", shift).bitwiseAND(F.lit((1 << bits) - 1)) for shift in (0, bits)]
    place = hashes.filter("h IS NOT NULL").select(F.explode(F.array(*slices)).alias("p"))
    bit = F.expr("shiftleft(1L, CAST(p & 63 AS INT))")
    words = place.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(bit).alias("v")).toArrow()
    out = np.zeros(1 << max(bits - 6, 0), dtype=np.int64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return BitTable(out.view(np.uint64), bits)
