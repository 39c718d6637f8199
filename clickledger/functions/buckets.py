"""Labelled ranges with a sort rank. Labels and bounds are fixed values of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (upper bound in seconds, exclusive; label). The last label takes the rest, 3600 s included.
PURCHASE_DELAY = [
    (300, "< 5 minutes"),
    (900, "5-15 minutes"),
    (1800, "15-30 minutes"),
    (3600, "30-60 minutes"),
    (None, "> 1 hour"),
]

# (lowest, highest click count, both included; label). The last label takes the rest.
CLICK_COUNT = [
    (1, 1, "1 click"),
    (2, 3, "2-3 clicks"),
    (4, 6, "4-6 clicks"),
    (None, None, "7+ clicks"),
]


def _first_true(conditions: list[Column], values: list) -> Column:
    """Value of the first condition that holds; the extra last value is the default."""
    *firsts, default = values
    result = F
    for condition, value in zip(conditions, firsts, strict=True):
        result = result.when(condition, F.lit(value))
    return result.otherwise(F.lit(default))


def purchase_delay_rank(seconds: Column) -> Column:
    bounds = [bound for bound, _ in PURCHASE_DELAY if bound is not None]
    return _first_true([seconds < b for b in bounds], list(range(1, len(PURCHASE_DELAY) + 1)))


def click_count_rank(clicks: Column) -> Column:
    ranges = [(low, high) for low, high, _ in CLICK_COUNT if low is not None]
    return _first_true(
        [clicks.between(low, high) for low, high in ranges], list(range(1, len(CLICK_COUNT) + 1))
    )


def label_of(rank: Column, table: list[tuple]) -> Column:
    """Label that stands at the rank in one of the tables above."""
    labels = [row[-1] for row in table]
    return F.element_at(F.array(*[F.lit(label) for label in labels]), rank)
