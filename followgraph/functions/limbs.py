"""Exact products and sums beyond BIGINT in three BIGINT limbs of 28 bits and the rest.

A product of two numbers under 2^56 is cut into limbs that add up independently: the two low ones
stay under 2^28, so BIGINT sums of them hold for 2^35 rows, and the high one for totals under
2^119. Decimals of 38 digits are objects to the JVM; limbs are plain numbers until the last row.
All functions keep the sign: low limbs are never negative, the high one carries it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, MOST = 28, 56
_MASK = (1 << BITS) - 1
LIMBS = ("limb_0", "limb_1", "limb_2")


def _checked(number: Column) -> Column:
    too_large = F.raise_error(F.lit(f"a factor of a sum in limbs has to be under 2^{MOST}")).cast("bigint")
    return F.when(number.between(1 - (1 << MOST), (1 << MOST) - 1) | number.isNull(), number).otherwise(too_large)


def product_limbs(a: Column, b: Column) -> list[Column]:
    """``a * b`` as limbs, lowest first; an error for factors of 2^56 and more."""
    a, b = _checked(a), _checked(b)
    a0, a1 = a.bitwiseAND(F.lit(_MASK)), F.shiftright(a, BITS)
    b0, b1 = b.bitwiseAND(F.lit(_MASK)), F.shiftright(b, BITS)
    low = a0 * b0
    mid = F.shiftright(low, BITS) + a1 * b0 + a0 * b1
    high = F.shiftright(mid, BITS) + a1 * b1
    columns = low.bitwiseAND(F.lit(_MASK)), mid.bitwiseAND(F.lit(_MASK)), high
    return [c.alias(name) for c, name in zip(columns, LIMBS, strict=True)]


def sum_limbs() -> list[Column]:
    """Aggregates that add up the limbs of many rows (zero for none)."""
    return [F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in LIMBS]


def high_low(df: DataFrame, name: str) -> DataFrame:
    """The limbs as two BIGINT columns: ``<name>_high`` counts 10^18, ``<name>_low`` is the rest."""
    others = [c for c in df.columns if c not in LIMBS]
    total = sum(
        (F.col(limb).cast("decimal(20,0)") * F.lit(Decimal(1 << (BITS * k))) for k, limb in enumerate(LIMBS)),
        F.lit(Decimal(0)),
    ).cast("decimal(38,0)")
    return df.select(*others, total.alias("__total")).selectExpr(
        *[f"`{c}`" for c in others],
        f"__total div 1000000000000000000 AS {name}_high",
        f"CAST(__total % 1000000000000000000 AS BIGINT) AS {name}_low",
    )
