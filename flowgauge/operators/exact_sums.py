"""Sums of doubles without rounding, so that sums and their differences are equal in any order and grouping.

A double is a whole number times a power of two. ``ExactDoubles`` writes a
column as a few whole numbers (limbs), each counting units ``2**width`` times
larger than the one before it; the smallest unit is that of the last bit of the
smallest value. Whole numbers add up exactly, whatever the order, and running
totals can be subtracted. NaN and the infinities are counted beside them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WHOLE = "decimal(38,0)"
#: Bits of a double's significand, and the exponent of its smallest unit.
_SIGNIFICAND = 53
_SMALLEST = -1074


def _finite(number: Column) -> Column:
    """The number, or NULL for NaN and the infinities."""
    return F.when(~F.isnan(number) & (F.abs(number) < F.lit(math.inf)), number)


def value_range(number: Column, names: tuple[str, str, str]) -> list[Column]:
    """Aggregates: smallest and largest size of the finite values but 0, and whether there are others."""
    size = F.abs(_finite(number))
    low, high, odd = names
    return [
        F.min(F.when(size > 0, size)).alias(low),
        F.max(size).alias(high),
        F.coalesce(F.bool_or(_finite(number).isNull() & number.isNotNull()), F.lit(False)).alias(odd),
    ]


@dataclass(frozen=True)
class ExactDoubles:
    """How the values of a column are written: ``limbs`` whole numbers of ``width`` bits from unit ``2**unit`` on."""

    unit: int
    width: int
    limbs: int
    odd: bool

    @classmethod
    def of_range(cls, low: float | None, high: float | None, odd: bool, rows: int) -> ExactDoubles:
        """A layout for sizes from ``low`` to ``high`` whose limbs of ``rows`` values add up within a bigint."""
        width = min(_SIGNIFICAND, 62 - max(rows, 1).bit_length())
        if not low:
            return cls(0, width, 1, odd)
        unit = max(math.frexp(low)[1] - _SIGNIFICAND, _SMALLEST)
        return cls(unit, width, -(-(math.frexp(high)[1] - unit) // width), odd)

    @property
    def names(self) -> list[str]:
        """The columns that ``split`` adds."""
        return [f"_limb{i}" for i in range(self.limbs)] + (["_nan", "_plus", "_minus"] if self.odd else [])

    def _scale(self, i: int) -> float:
        return math.ldexp(1.0, self.unit + self.width * i)

    def split(self, df: DataFrame, number: Column) -> DataFrame:
        """``df`` with the limbs (bigint) of ``number``; a NULL counts as 0 in each."""
        out = df.withColumn("_left", F.coalesce(_finite(number), F.lit(0.0)))
        for i in reversed(range(self.limbs)):  # what is taken off are leading bits, so nothing is rounded
            out = out.withColumn(f"_limb{i}", (F.col("_left") / F.lit(self._scale(i))).cast("bigint"))
            out = out.withColumn("_left", F.col("_left") - F.col(f"_limb{i}") * F.lit(self._scale(i)))
        if self.odd:
            marks = {"_nan": F.isnan(number), "_plus": number == F.lit(math.inf), "_minus": number == F.lit(-math.inf)}
            out = out.withColumns({n: F.coalesce(m, F.lit(False)).cast("bigint") for n, m in marks.items()})
        return out.drop("_left")

    def total(self, sums: Mapping[str, Column]) -> Column:
        """The sum as a double, from the sums of the columns in ``names``."""
        whole = [sums[f"_limb{i}"].cast(_WHOLE) for i in range(self.limbs)]
        base, half = F.lit(2**self.width).cast(_WHOLE), F.lit(2 ** (self.width - 1)).cast(_WHOLE)

        def carry_on(state: Column, limb: Column) -> Column:
            here = (limb + state["carry"]).cast(_WHOLE)
            # digits from -half to half, so a digit is never made up by those below it
            digit = (F.pmod((here + half).cast(_WHOLE), base) - half).cast(_WHOLE)
            carry = F.call_function("div", (here - digit).cast(_WHOLE), base).cast(_WHOLE)
            return F.struct(carry.alias("carry"), F.concat(state["digits"], F.array(digit.cast("double"))).alias("digits"))

        top = whole[-1]
        found = F.lit(0.0)
        if self.limbs > 1:
            start = F.struct(F.lit(0).cast(_WHOLE).alias("carry"), F.array().cast("array<double>").alias("digits"))
            below = F.aggregate(F.array(*whole[:-1]), start, carry_on)
            top = (top + below["carry"]).cast(_WHOLE)
            scales = F.array(*[F.lit(self._scale(i)) for i in range(self.limbs - 1)])
            parts = F.zip_with(below["digits"], scales, lambda x, y: x * y)
            found = F.aggregate(parts, F.lit(0.0), lambda x, y: x + y)  # from the smallest on
        found = top.cast("double") * F.lit(self._scale(self.limbs - 1)) + found
        if not self.odd:
            return found
        nan, plus, minus = (sums[n] > 0 for n in ("_nan", "_plus", "_minus"))
        return (
            F.when(nan | (plus & minus), F.lit(math.nan))
            .when(plus, F.lit(math.inf))
            .when(minus, F.lit(-math.inf))
            .otherwise(found)
        )
