"""Event-time expressions that work on TIMESTAMP and TIMESTAMP_NTZ columns alike."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse_event_time(text: Column) -> Column:
    """ISO text to an instant; a missing fraction or an offset is fine, bad text gives NULL."""
    return F.try_to_timestamp(text)


def elapsed_seconds(earlier: Column, later: Column) -> Column:
    """Whole seconds between two times, each side truncated to its second first."""
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def hour_of(df: DataFrame, name: str) -> Column:
    """Start of the hour, in the column's own timestamp type."""
    return F.date_trunc("hour", F.col(name)).cast(df.schema[name].dataType)


#: A clock: given, a function of how far to look back, or None for now.
AsOf = Column | datetime | Callable[[timedelta], Column] | None


def before(as_of: AsOf, back: timedelta) -> Column:
    """The time ``back`` before the clock.

    A clock that is a subquery should be a function, which subtracts inside the subquery: only then is
    the bound a plain value to the scan, and pushed into it.
    """
    if callable(as_of) and not isinstance(as_of, Column):
        return as_of(back)
    if as_of is None:
        as_of = F.current_timestamp()
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)) - F.lit(back)


def within_last(column: Column, hours: float, as_of: AsOf = None) -> Column:
    """True for times not older than ``hours`` before ``as_of``."""
    return column >= before(as_of, timedelta(hours=hours))


def slot_of(column: Column, seconds: int) -> Column:
    """Index of the fixed-width time slot that holds the time."""
    return F.floor(F.unix_timestamp(column) / F.lit(seconds))


def slots_between(first: Column, last: Column, seconds: int) -> Column:
    """Indices of all slots from that of one time to that of another, both included."""
    return F.sequence(slot_of(first, seconds), slot_of(last, seconds))


def slot_start(slot: Column, seconds: int) -> Column:
    """The instant a slot begins."""
    return F.timestamp_seconds(slot * F.lit(seconds))


def days_between(first: Column, last: Column) -> Column:
    """All days from that of one time to that of another, both included."""
    return F.sequence(F.to_date(first), F.to_date(last))


def whole_seconds(window: timedelta) -> int:
    """Length of an attribution window, which must be a positive whole number of seconds."""
    seconds = int(window.total_seconds())
    if seconds < 1 or timedelta(seconds=seconds) != window:
        raise ValueError(f"attribution window must be whole seconds, got {window!r}")
    return seconds
