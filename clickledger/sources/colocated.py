"""Bucketed catalog tables on which attribution and its joins need no shuffle of the feeds.

Clicks and checkouts lie on one timeline table, bucketed by user and time slot. A slot is eight times as
wide as the widest window asked for, so a busy user's history spreads over many buckets. A checkout is in
its own slot; a click is in its own slot and, if its reach ends in the next one, there too. So each slot
holds all clicks that a checkout of it can be credited to.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.functions.times import slot_of, whole_seconds
from clickledger.operators.first_click import (
    ATTRIBUTION_WINDOW,
    CHECKOUT_FIELDS,
    CLICK_FIELDS,
    attribution_columns,
    nearest_click,
    usable,
)
from clickledger.streaming.sinks import first_copies

#: A slot is so many times as wide as the reach, so at most one click in so many is stored twice.
SLOT_REACHES = 8
_KEY = ("user_id", "slot")
_REACH = "clickledger.reach.seconds"


def _save(df: DataFrame, name: str, path: str, buckets: int, key: tuple[str, ...], sort: tuple[str, ...]) -> None:
    """One file a bucket: rows are dealt by the key that the table is bucketed by."""
    dealt = df.repartition(buckets, *key)
    dealt.write.bucketBy(buckets, *key).sortBy(*sort).option("path", path).mode("overwrite").saveAsTable(name)


def write_timeline(
    clicks: DataFrame,
    checkouts: DataFrame,
    name: str,
    path: str,
    buckets: int,
    reach: timedelta = ATTRIBUTION_WINDOW,
) -> None:
    """Store both feeds as catalog table ``name`` with files under ``path``.

    ``reach`` is the widest window that may be asked for later. Choose ``buckets`` so that one fits a
    task; a bucket is read by one. Repeated deliveries are stored once, of differing copies the earliest.
    Rows without a user or a time match nothing and are left out. ``path`` must be a folder of its own.
    """
    seconds = whole_seconds(reach)
    width = SLOT_REACHES * seconds
    at = F.col("event_timestamp")
    clicks = first_copies(usable(clicks).select("user_id", *CLICK_FIELDS), "event_id", "event_timestamp")
    checkouts = first_copies(
        usable(checkouts).select("user_id", "event_timestamp", *CHECKOUT_FIELDS), "event_id", "event_timestamp"
    )
    both_slots = F.array_distinct(F.array(slot_of(at, width), slot_of(at + F.lit(reach), width)))
    rows = clicks.select("user_id", F.explode(both_slots).alias("slot"), at.alias("at"), F.struct(*CLICK_FIELDS).alias("click"))
    probes = checkouts.select("user_id", slot_of(at, width).alias("slot"), at.alias("at"), F.struct(*CHECKOUT_FIELDS).alias("checkout"))
    _save(rows.unionByName(probes, allowMissingColumns=True), name, path, buckets, _KEY, (*_KEY, "at"))
    spark = clicks.sparkSession
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_REACH}' = '{seconds}')")


def write_users(users: DataFrame, name: str, path: str, buckets: int) -> None:
    """Store the users dimension as catalog table ``name``, bucketed by user."""
    _save(users, name, path, buckets, ("user_id",), ("user_id",))


def _timeline(spark: SparkSession, name: str, window: timedelta) -> DataFrame:
    reach = int(spark.sql(f"SHOW TBLPROPERTIES {name}('{_REACH}')").first().value)
    if whole_seconds(window) > reach:
        raise ValueError(f"{name} reaches back {reach} seconds, a window of {window} needs more")
    return spark.table(name)


def first_click_attribution(
    spark: SparkSession, name: str, window: timedelta = ATTRIBUTION_WINDOW
) -> DataFrame:
    """Attribution over a timeline table: one scan and one sort, no shuffle and no pairs."""
    until = F.when(F.col("checkout").isNotNull(), F.col("at"))
    probe_at = F.when(F.col("checkout").isNull(), F.col("at")).otherwise(F.col("at") - F.lit(window))
    rows = _timeline(spark, name, window).select(*_KEY, probe_at.alias("at"), until.alias("until"), "click", "checkout")
    winners = nearest_click(rows).select(
        F.col("checkout.event_id").alias("checkout_id"),
        "user_id",
        F.col("until").alias("checkout_timestamp"),
        "click",
        F.col("checkout.total_amount").alias("revenue"),
    )
    return attribution_columns(winners)


def attribution_pairs(
    spark: SparkSession, name: str, window: timedelta = ATTRIBUTION_WINDOW
) -> DataFrame:
    """All (checkout, click) pairs of a timeline table, joined bucket by bucket.

    A pair is formed in the checkout's slot alone, where every click of its window is stored once.
    """
    rows = _timeline(spark, name, window)
    left = rows.where("checkout IS NOT NULL").select(
        *_KEY,
        F.col("checkout.event_id").alias("checkout_event_id"),
        F.col("at").alias("checkout_event_timestamp"),
        F.col("checkout.total_amount").alias("checkout_total_amount"),
    )
    right = rows.where("click IS NOT NULL").select(*_KEY, *[F.col(f"click.{c}").alias(f"click_{c}") for c in CLICK_FIELDS])
    at, click_at = F.col("checkout_event_timestamp"), F.col("click_event_timestamp")
    return (
        left.join(right, [*_KEY])
        .where((click_at <= at) & (click_at >= at - F.lit(window)))
        .withColumnRenamed("user_id", "checkout_user_id")
        .drop("slot")
    )


def segment_performance(attributed: DataFrame, users: DataFrame) -> DataFrame:
    """Orders, customers and revenue per segment, with one row a user in the join.

    Credits of a table with one row a checkout are added up by user first, map-side, so that a busy user
    costs a row a task; users in a table bucketed by user are joined where they lie.
    """
    by_user = attributed.groupBy("user_id").agg(
        F.count("*").alias("orders"), F.sum("revenue").alias("revenue"), F.count("revenue").alias("amounts")
    )
    revenue, customers = F.sum("revenue"), F.count("*")
    return (
        by_user.join(users.select("user_id", "customer_segment"), "user_id")
        .groupBy("customer_segment")
        .agg(
            F.sum("orders").alias("total_orders"),
            customers.alias("active_customers"),
            revenue.alias("total_revenue"),
            F.round(revenue.cast("double") / F.nullif(F.sum("amounts"), F.lit(0)), 6).alias("avg_order_value"),
            F.round(revenue.cast("double") / F.nullif(customers, F.lit(0)), 6).alias("revenue_per_customer"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first())
    )
