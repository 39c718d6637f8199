"""Interval join: every click of the same user in the window before a checkout."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.functions.times import days_between, slot_of, slot_start, whole_seconds
from clickledger.operators.first_click import ATTRIBUTION_WINDOW, CLICK_FIELDS


def attribution_pairs(
    clicks: DataFrame,
    checkouts: DataFrame,
    window: timedelta = ATTRIBUTION_WINDOW,
    day: str | None = None,
) -> DataFrame:
    """All (checkout, click) pairs with the click in ``[checkout - window, checkout]``.

    Time is cut into slots as wide as the window and the slot joins the key, so a window touches
    exactly two slots: each checkout is looked up in its own and the one before, each click lies in
    one. Busy users spread over their slots, and the range test runs on at most two windows of
    clicks, so the work follows the size of the result. Adaptive skew splitting covers the rest.

    ``day`` names the date column that stored clicks have folders of, made from their time. It joins the
    key, so the days of a selection of checkouts prune the scan of the clicks while the query runs, where
    the selection is small enough to be broadcast. Click columns that the clicks lack are left
    out.
    """
    seconds = whole_seconds(window)
    left = checkouts.select(
        F.col("event_id").alias("checkout_event_id"),
        F.col("user_id"),
        F.col("event_timestamp").alias("checkout_event_timestamp"),
        F.col("total_amount").alias("checkout_total_amount"),
        F.explode(
            F.array(
                slot_of(F.col("event_timestamp"), seconds) - 1,
                slot_of(F.col("event_timestamp"), seconds),
            )
        ).alias("slot"),
    )
    key = ["user_id", "slot"]
    if day is not None:
        until, kind = F.col("checkout_event_timestamp"), checkouts.schema["event_timestamp"].dataType
        first = F.greatest(until - F.lit(window), slot_start(F.col("slot"), seconds).cast(kind))
        last = F.least(until, slot_start(F.col("slot") + 1, seconds).cast(kind))
        left = left.withColumn(day, F.explode(days_between(first, last)))
        key.append(day)
    right = clicks.select(
        F.col("user_id"),
        slot_of(F.col("event_timestamp"), seconds).alias("slot"),
        *key[2:],
        *[F.col(c).alias(f"click_{c}") for c in CLICK_FIELDS if c in clicks.columns],
    )
    at, click_at = F.col("checkout_event_timestamp"), F.col("click_event_timestamp")
    return (
        left.join(right, key)
        .where((click_at <= at) & (click_at >= at - F.lit(window)))
        .withColumnRenamed("user_id", "checkout_user_id")
        .drop(*key[1:])
    )
