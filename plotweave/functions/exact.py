"""Sums that do not depend on the order of their terms: whole numbers of a common unit.

Floating-point sums differ with the order in which tasks and partitions are added up. Here every
value is rounded to a multiple of a unit, a power of two, and the multiples are summed as
integers. So a retried task, or another partitioning, gives the same bits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# A value takes so many bits; each of two sums takes half of them and some 2**34 rows.
BITS = 58
HALF = BITS // 2


def unit_of(bound: float, bits: int = BITS) -> float:
    """The unit in which numbers up to ``bound`` have ``bits`` bits."""
    return math.ldexp(1.0, max(math.frexp(bound)[1] - bits, -1000)) if bound else 1.0


def units(value: Column, unit: float) -> Column:
    """``value`` as a whole number of units."""
    return F.rint(value / F.lit(unit)).cast("long")


def sum_parts(whole: Column, name: str) -> list[Column]:
    """Aggregates ``<name>_high`` and ``<name>_low`` for the sum of whole numbers."""
    return [
        F.sum(F.shiftright(whole, HALF)).alias(f"{name}_high"),
        F.sum(whole.bitwiseAND(F.lit((1 << HALF) - 1))).alias(f"{name}_low"),
    ]


def sum_of(name: str, unit: float) -> Column:
    """The sum that ``sum_parts`` has prepared, as double."""
    high, low = F.col(f"{name}_high").cast("double"), F.col(f"{name}_low").cast("double")
    return (high * F.lit(float(1 << HALF)) + low) * F.lit(unit)
