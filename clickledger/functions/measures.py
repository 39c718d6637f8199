"""Exact money arithmetic and the aggregate expressions the reports share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide integer-valued decimal: decimal division of two of these keeps 18 fractional digits.
_WIDE = "decimal(20,0)"


def total(column: str) -> Column:
    return F.sum(column)


def mean(column: str) -> Column:
    """Average as a double rounded to six decimals, taken from the exact sum."""
    return F.round(F.sum(column).cast("double") / F.count(column), 6)


def exact_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Decimal division rounded half up; NULL when the denominator is zero."""
    return F.round(numerator / F.nullif(denominator, F.lit(0).cast(_WIDE)), digits)


def rounded_mean(column: str, digits: int = 2) -> Column:
    """Average of a decimal column, divided and rounded in decimal arithmetic."""
    return exact_ratio(F.sum(column), F.count(column).cast(_WIDE), digits)


def wide(column: Column) -> Column:
    return column.cast(_WIDE)
