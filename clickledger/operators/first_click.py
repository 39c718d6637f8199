"""First-click attribution: each checkout's earliest click in the window before it.

Joining every checkout to all clicks of its window and ranking the pairs is quadratic in a busy
user's traffic. The earliest click of ``[t - w, t]`` is the first click at or after ``t - w``,
provided it is not later than ``t``. So clicks and probes (placed at ``t - w``) are put on one timeline,
and one backward pass over it carries the nearest click along: one shuffle and one sort, no pairs.

Every user's timeline is cut into slots of an eighth of the window, so a busy user's rows spread over
many tasks. A click is in one slot; a checkout's probe is in each slot its window touches, and the
earliest of its answers counts.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickledger.functions.times import AsOf, before, elapsed_seconds, slot_of, slots_between, whole_seconds

ATTRIBUTION_WINDOW = timedelta(hours=1)

# Order matters: the earliest click wins, and of equally early ones the lowest id.
CLICK_FIELDS = [
    "event_timestamp",
    "event_id",
    "product_id",
    "product_name",
    "product_category",
    "referrer",
    "device_type",
]
CHECKOUT_FIELDS = ["event_id", "total_amount"]


def first_click_attribution(
    clicks: DataFrame,
    checkouts: DataFrame,
    window: timedelta = ATTRIBUTION_WINDOW,
    since: AsOf = None,
) -> DataFrame:
    """One row per checkout that has a click of the same user in ``[checkout - window, checkout]``.

    ``since`` limits the result to checkouts from that time on; it reaches both scans.
    """
    return attribution_columns(first_clicks(clicks, checkouts, window, since))


def first_clicks(
    clicks: DataFrame,
    checkouts: DataFrame,
    window: timedelta = ATTRIBUTION_WINDOW,
    since: AsOf = None,
) -> DataFrame:
    """As :func:`first_click_attribution`, with checkout columns and the credited ``click`` struct."""
    width = slot_seconds(window)
    length = F.lit(window)
    clicks, checkouts = usable(clicks), usable(checkouts)
    if since is not None:
        checkouts = checkouts.where(F.col("event_timestamp") >= before(since, timedelta(0)))
        clicks = clicks.where(F.col("event_timestamp") >= before(since, window))

    clicks = clicks.select(
        "user_id",
        F.col("event_timestamp").alias("at"),
        F.struct(*CLICK_FIELDS).alias("click"),
        slot_of(F.col("event_timestamp"), width).alias("slot"),
    )
    until = F.col("event_timestamp")
    probes = checkouts.select(
        "user_id",
        (until - length).alias("at"),
        until.alias("until"),
        F.struct(*CHECKOUT_FIELDS).alias("checkout"),
        F.explode(slots_between(until - length, until, width)).alias("slot"),
    )
    matched = nearest_click(clicks.unionByName(probes, allowMissingColumns=True))

    # Answers of several slots and repeated deliveries end as one row a checkout, combined map-side.
    return (
        matched.groupBy(F.col("checkout.event_id").alias("checkout_id"))
        .agg(F.min(F.struct("click", "user_id", "until", "checkout")).alias("m"))
        .select(
            "checkout_id",
            F.col("m.user_id").alias("user_id"),
            F.col("m.until").alias("checkout_timestamp"),
            F.col("m.click").alias("click"),
            F.col("m.checkout.total_amount").alias("revenue"),
        )
    )


def attribution_columns(winners: DataFrame, *extra: str) -> DataFrame:
    """Attribution table layout from checkout columns plus the credited ``click`` struct."""
    first = F.col("click.event_timestamp")
    return winners.select(
        "checkout_id",
        "user_id",
        "checkout_timestamp",
        F.col("click.event_id").alias("attributed_click_id"),
        F.col("click.product_id").alias("attributed_product_id"),
        F.col("click.product_name").alias("attributed_product_name"),
        F.col("click.product_category").alias("attributed_category"),
        F.col("click.referrer").alias("traffic_source"),
        F.col("click.device_type").alias("device_type"),
        first.alias("first_click_timestamp"),
        "revenue",
        elapsed_seconds(first, F.col("checkout_timestamp")).alias("attribution_window_seconds"),
        *extra,
    )


def usable(feed: DataFrame) -> DataFrame:
    """Rows that can match at all: NULL users and times never satisfy the join condition."""
    return feed.where(F.col("user_id").isNotNull() & F.col("event_timestamp").isNotNull())


def slot_seconds(window: timedelta) -> int:
    """Width of the time slots: a window touches nine of them at most, ten if it has no eighth."""
    return max(1, whole_seconds(window) // 8)


def nearest_click(timeline: DataFrame) -> DataFrame:
    """Probes of the timeline with their slot's first click at or after them, if not after ``until``.

    Walking backwards, a click at a probe's own instant has to be passed before the probe, and the
    lowest id of equal times last. A probe of an earlier slot stands before all clicks.
    """
    backwards = (
        Window.partitionBy("user_id", "slot")
        .orderBy(
            F.col("at").desc(),
            F.col("until").isNotNull(),
            F.col("click.event_id").desc(),
        )
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return timeline.withColumn("click", F.last("click", ignorenulls=True).over(backwards)).where(
        F.col("until").isNotNull() & (F.col("click.event_timestamp") <= F.col("until"))
    )
