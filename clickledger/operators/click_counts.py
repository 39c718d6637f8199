"""Number of clicks in the window before each checkout, without forming the pairs.

The count of clicks in ``[t - w, t]`` is a user's running click count at ``t`` (its own instant included)
less that just before ``t - w``, so a checkout is two rows however wide the window is. A running count is
that within a time slot plus the clicks of all slots before. Timelines are cut into slots, so a busy user
spreads over many tasks; what came before a slot is summed over one row per user and slot.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickledger.functions.times import slot_of
from clickledger.operators.first_click import ATTRIBUTION_WINDOW, slot_seconds, usable

# Position of rows that share an instant: window starts come before clicks, window ends after. What came
# before the slot has no instant and stands first.
_START, _CLICK, _END = 0, 1, 2
#: Seconds of a slot at most: however wide the window is, a task gets no more of one user at once.
WIDEST_SLOT = 3600


def clicks_in_window(
    clicks: DataFrame, checkouts: DataFrame, window: timedelta = ATTRIBUTION_WINDOW
) -> DataFrame:
    """(checkout_id, user_id, total_clicks_in_window) for checkouts with at least one click."""
    width = min(slot_seconds(window), WIDEST_SLOT)
    at = F.col("event_timestamp")
    start = at - F.lit(window)
    steps = usable(clicks).select(
        "user_id",
        at.alias("at"),
        F.lit(_CLICK).alias("place"),
        F.lit(1).cast("long").alias("weight"),
        slot_of(at, width).alias("slot"),
    )
    begin = F.struct(start.alias("at"), F.lit(_START).alias("place"), slot_of(start, width).alias("slot"))
    end = F.struct(at.alias("at"), F.lit(_END).alias("place"), slot_of(at, width).alias("slot"))
    probes = usable(checkouts).select(
        "user_id",
        F.col("event_id").alias("checkout_id"),
        F.lit(True).alias("probe"),
        F.inline(F.array(begin, end)),
    )
    timeline = (
        steps.unionByName(probes, allowMissingColumns=True)
        .unionByName(_clicks_before(steps, probes), allowMissingColumns=True)
    )
    forwards = (
        Window.partitionBy("user_id", "slot")
        .orderBy("at", "place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = F.coalesce(F.sum("weight").over(forwards), F.lit(0))
    counted = timeline.withColumn(
        "n", F.when(F.col("place") == _START, -running).otherwise(running)
    ).where("probe")
    return (
        counted.groupBy("checkout_id", "user_id")
        .agg(F.sum("n").alias("total_clicks_in_window"))
        .where(F.col("total_clicks_in_window") > 0)
    )


def _clicks_before(steps: DataFrame, probes: DataFrame) -> DataFrame:
    """(user_id, slot, weight): a user's clicks in all slots before each slot that has any row."""
    rows = steps.select("user_id", "slot", "weight").unionAll(
        probes.select("user_id", "slot", F.lit(0).cast("long").alias("weight"))
    )
    totals = rows.groupBy("user_id", "slot").agg(F.sum("weight").alias("clicks"))
    earlier = Window.partitionBy("user_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("user_id", "slot", F.sum("clicks").over(earlier).alias("weight"))
