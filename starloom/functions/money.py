"""Exact decimal money arithmetic.

Rules (all JVM-side expressions, no floating point anywhere):
* rounding is half away from zero on exact decimals (Spark's ``round`` on DecimalType);
* a mean is ``sum / count`` on the decimal sum, never ``avg`` followed by ``round``,
  because ``avg`` already rounds to scale 6 and a second rounding can differ;
* an aggregated amount is cast to ``MONEY_TOTAL`` before it feeds another aggregate,
  window or ratio so that the intermediate scale stays large.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A total of order-line amounts (Spark's own result type of SUM over decimal(12,2)).
MONEY_TOTAL = T.DecimalType(22, 2)
# Percentages with two decimals.
PCT = T.DecimalType(22, 2)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Cast an amount to the total-money type (22,2)."""
    return col(c).cast(MONEY_TOTAL)


def round2(c: str | Column) -> Column:
    """ROUND(x, 2), half away from zero, on an exact decimal."""
    return F.round(col(c), 2)


def rounded_money(c: str | Column) -> Column:
    return round2(c).cast(MONEY_TOTAL)


def mean(total: str | Column, count: str | Column) -> Column:
    """Exact mean of a decimal column: total / count (scale 18 for a (22,2) sum)."""
    return col(total) / col(count)


def rounded_mean(total: str | Column, count: str | Column) -> Column:
    return round2(mean(total, count)).cast(MONEY_TOTAL)


def pct(part: str | Column, whole: str | Column, *, guard_zero: bool = True) -> Column:
    """ROUND(part / whole * 100, 2).

    ``guard_zero`` mirrors ``NULLIF(whole, 0)``: a zero denominator gives NULL. Without the
    guard, ANSI mode raises DIVIDE_BY_ZERO, as the reference engine does.
    """
    denom = F.nullif(col(whole), F.lit(0)) if guard_zero else col(whole)
    return round2(col(part) / denom * F.lit(100)).cast(PCT)


def growth_pct(current: str | Column, previous: str | Column) -> Column:
    """ROUND((current - previous) / NULLIF(previous, 0) * 100, 2)."""
    return pct(col(current) - col(previous), previous, guard_zero=True)


def decimal_lit(value: str, precision: int, scale: int) -> Column:
    """A decimal literal that never passes through a double."""
    return F.lit(value).cast(T.DecimalType(precision, scale))
