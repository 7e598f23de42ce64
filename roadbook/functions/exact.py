"""Order-independent sums and correctly rounded ratios.

Averages of one-decimal speeds often sit exactly on a rounding tie, and a sum
of doubles depends on the order in which tasks finish. So measurements are
summed as whole numbers of a fixed unit, and a quotient is formed and rounded
once, at the end, in integer arithmetic. The per-row part is a ``floor`` to
``bigint`` (no decimals in the hot path); the wide decimals appear once a group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def units(col: Column | str, scale: int = 4) -> Column:
    """``col`` as a whole number of 10**-scale steps (bigint)."""
    col = F.col(col) if isinstance(col, str) else col
    return F.floor(col * F.lit(float(10**scale)) + F.lit(0.5))


def wide(col: Column) -> Column:
    """A bigint widened so that products of group totals cannot overflow."""
    return col.cast("decimal(38,0)")


def half_away(numerator: Column, denominator: Column) -> Column:
    """Whole numbers divided and rounded, ties away from zero; NULL for a zero denominator.

    ``div`` drops the fraction, so half a denominator is added first, on the
    numerator's side of zero. The denominator is not negative.
    """
    d = F.nullif(denominator, F.lit(0))
    return F.call_function("div", numerator * 2 + F.when(numerator < 0, -d).otherwise(d), d * 2)


def ratio(numerator: Column, denominator: Column, scale: int = 2) -> Column:
    """numerator / denominator as a double, for a numerator counted in 10**-scale steps."""
    return half_away(wide(numerator), wide(denominator)) / F.lit(float(10**scale))


def total(col: str, scale: int) -> Column:
    """Aggregate: sum of a column that holds ``scale`` decimals."""
    return wide_sum(units(col, scale)).cast("double") / F.lit(float(10**scale))


def wide_sum(steps: Column) -> Column:
    """Aggregate: sum of bigints as a wide whole number, in two halves that are bigints each."""
    return wide(F.sum(F.shiftright(steps, 20))) * 2**20 + wide(F.sum(steps.bitwiseAND(F.lit(2**20 - 1))))


def long_total(col: str, scale: int) -> Column:
    """Aggregate: sum of ``col`` in 10**-scale steps, as a wide whole number.

    For measurements with many decimals: their steps are summed in two halves
    of 2**20 each, both bigints, so that neither a group of 10**11 rows
    overflows nor the hot path needs a decimal.
    """
    return wide_sum(units(col, scale))


def mean(col: str, scale: int) -> Column:
    """Aggregate: unrounded average of a column that holds ``scale`` decimals."""
    return total(col, scale) / F.nullif(F.count(col), F.lit(0)).cast("double")
