"""The analytical reports. Each takes tables as DataFrames and returns a small ordered DataFrame.

Revenue sums stay exact decimals; plain averages are doubles rounded to six digits; values the report
itself rounds are divided and rounded half up in decimal arithmetic. Descending orders put NULLs
first.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickledger.functions.buckets import (
    CLICK_COUNT,
    PURCHASE_DELAY,
    click_count_rank,
    label_of,
    purchase_delay_rank,
)
from clickledger.functions.measures import exact_ratio, mean, rounded_mean, total, wide
from clickledger.functions.times import AsOf, hour_of, within_last
from clickledger.operators.click_counts import clicks_in_window
from clickledger.operators.first_click import ATTRIBUTION_WINDOW



def revenue_by_source(attributed: DataFrame) -> DataFrame:
    """Conversions and revenue per traffic source, with the share of all revenue in percent."""
    by_source = attributed.groupBy("traffic_source").agg(
        F.count("*").alias("total_conversions"),
        total("revenue").alias("total_revenue"),
        mean("revenue").alias("avg_order_value"),
    )
    # A scalar subquery over the grouped rows reuses their shuffle; no window over one partition.
    all_revenue = by_source.agg(F.sum("total_revenue")).scalar()
    share = F.round(F.col("total_revenue") * 100 / F.nullif(all_revenue, F.lit(0)), 2)
    return by_source.withColumn("revenue_percentage", share).orderBy(
        F.col("total_revenue").desc_nulls_first()
    )


def time_to_purchase(attributed: DataFrame) -> DataFrame:
    """Conversions and average revenue by time from the first click to the order."""
    rank = purchase_delay_rank(F.col("attribution_window_seconds")).alias("bucket_rank")
    return (
        attributed.groupBy(rank)
        .agg(
            F.count("*").alias("conversion_count"),
            rounded_mean("revenue").alias("avg_revenue"),
        )
        .orderBy("bucket_rank")
        .select(
            label_of(F.col("bucket_rank"), PURCHASE_DELAY).alias("time_bucket"),
            "conversion_count",
            "avg_revenue",
        )
    )


def category_totals(attributed: DataFrame) -> DataFrame:
    return attributed.groupBy("attributed_category").agg(
        F.count("*").alias("conversion_count"),
        total("revenue").alias("total_revenue"),
        mean("revenue").alias("avg_order_value"),
        F.count_distinct("user_id").alias("unique_customers"),
    )


def category_performance(attributed: DataFrame, top: int = 10) -> DataFrame:
    """The categories with the most revenue."""
    return (
        category_totals(attributed)
        .orderBy(F.col("total_revenue").desc_nulls_first(), "attributed_category")
        .limit(top)
    )


def device_conversion(attributed: DataFrame) -> DataFrame:
    """Conversions, revenue and minutes to purchase per device type."""
    seconds = "attribution_window_seconds"
    return (
        attributed.groupBy("device_type")
        .agg(
            F.count("*").alias("conversions"),
            F.round(total("revenue"), 2).alias("total_revenue"),
            rounded_mean("revenue").alias("avg_order_value"),
            exact_ratio(wide(F.sum(seconds)), wide(F.count(seconds) * 60)).alias(
                "avg_minutes_to_purchase"
            ),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first())
    )


def hourly_revenue(attributed: DataFrame, hours: float = 24, as_of: AsOf = None) -> DataFrame:
    """Conversions and revenue per hour over the last ``hours``, newest first."""
    recent = attributed.where(within_last(F.col("checkout_timestamp"), hours, as_of))
    return (
        recent.groupBy(hour_of(recent, "checkout_timestamp").alias("hour"))
        .agg(
            F.count("*").alias("conversions"),
            total("revenue").alias("hourly_revenue"),
            mean("revenue").alias("avg_order_value"),
        )
        .orderBy(F.col("hour").desc())
    )


def segment_performance(attributed: DataFrame, users: DataFrame) -> DataFrame:
    """Orders, customers and revenue per customer segment.

    The users table grows with the shop, so the join strategy is left to the size checks of the
    optimizer: broadcast below the threshold, shuffled with skew splitting above it.
    """
    joined = attributed.select("user_id", "checkout_id", "revenue").join(
        users.select("user_id", "customer_segment"), "user_id"
    )
    customers = F.count_distinct("user_id")
    return (
        joined.groupBy("customer_segment")
        .agg(
            F.count_distinct("checkout_id").alias("total_orders"),
            customers.alias("active_customers"),
            total("revenue").alias("total_revenue"),
            mean("revenue").alias("avg_order_value"),
            F.round(
                F.sum("revenue").cast("double") / F.nullif(customers, F.lit(0)), 6
            ).alias("revenue_per_customer"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first())
    )


def top_products(attributed: DataFrame, top: int = 20) -> DataFrame:
    """The products with the most conversions; ties go to revenue, then to the product id."""
    return (
        attributed.groupBy(
            "attributed_product_id", "attributed_product_name", "attributed_category"
        )
        .agg(
            F.count("*").alias("conversion_count"),
            total("revenue").alias("total_attributed_revenue"),
        )
        .orderBy(
            F.col("conversion_count").desc(),
            F.col("total_attributed_revenue").desc_nulls_first(),
            "attributed_product_id",
            "attributed_product_name",
            "attributed_category",
        )
        .limit(top)
    )


def click_to_checkout_rate(
    clicks: DataFrame, checkouts: DataFrame, hours: float = 1, as_of: AsOf = None
) -> DataFrame:
    """Distinct clicks and checkouts of the last ``hours`` and their ratio in percent."""

    def recent_ids(events: DataFrame, is_click: bool) -> DataFrame:
        recent = events.where(within_last(F.col("event_timestamp"), hours, as_of))
        return recent.select("event_id", F.lit(is_click).alias("is_click"))

    # Both feeds are de-duplicated in one shuffle and counted in one row: nothing to join.
    ids = recent_ids(clicks, True).unionAll(recent_ids(checkouts, False))
    counted = (
        ids.where(F.col("event_id").isNotNull())
        .distinct()
        .agg(
            F.count_if(F.col("is_click")).alias("total_clicks"),
            F.count_if(~F.col("is_click")).alias("total_checkouts"),
        )
    )
    return counted.withColumn(
        "conversion_rate",
        exact_ratio(wide(F.col("total_checkouts") * 100), wide(F.col("total_clicks"))),
    )


def clicks_per_checkout(
    clicks: DataFrame,
    checkouts: DataFrame,
    window: timedelta = ATTRIBUTION_WINDOW,
) -> DataFrame:
    """How many checkouts had one, a few or many clicks in the window before them."""
    counts = clicks_in_window(clicks, checkouts, window)
    rank = click_count_rank(F.col("total_clicks_in_window")).alias("bucket_rank")
    return (
        counts.groupBy(rank)
        .agg(F.count("*").alias("checkout_count"))
        .orderBy("bucket_rank")
        .select(label_of(F.col("bucket_rank"), CLICK_COUNT).alias("click_bucket"), "checkout_count")
    )


def pipeline_health(
    clicks: DataFrame,
    checkouts: DataFrame,
    attributed: DataFrame,
    hours: float = 1,
    as_of: AsOf = None,
) -> DataFrame:
    """Four (metric, value) rows on the last ``hours``; labels are fixed values for one hour."""

    def recent(events: DataFrame, time: str) -> DataFrame:
        return events.where(within_last(F.col(time), hours, as_of))

    def row(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), value.cast("double").alias("value"))

    revenue = F.round(F.coalesce(F.sum("revenue"), F.lit(0)), 2)
    parts = [
        recent(clicks, "event_timestamp").agg(
            F.array(row("Clicks (Last Hour)", F.count("*"))).alias("rows")
        ),
        recent(checkouts, "event_timestamp").agg(
            F.array(row("Checkouts (Last Hour)", F.count("*"))).alias("rows")
        ),
        recent(attributed, "checkout_timestamp").agg(
            F.array(
                row("Attributed Checkouts (Last Hour)", F.count("*")),
                row("Total Revenue (Last Hour)", revenue),
            ).alias("rows")
        ),
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).select(F.inline("rows"))


def users_by_segment(users: DataFrame) -> DataFrame:
    """Users and lifetime value per segment."""
    return (
        users.groupBy("customer_segment")
        .agg(
            F.count("*").alias("user_count"),
            mean("lifetime_value").alias("avg_lifetime_value"),
            total("lifetime_value").alias("total_lifetime_value"),
        )
        .orderBy(F.col("total_lifetime_value").desc_nulls_first())
    )


def seed_summary(users: DataFrame) -> DataFrame:
    """Status line after loading the users, with their number."""
    return users.agg(F.count("*").alias("total_users")).select(
        F.lit("Seed data inserted successfully!").alias("status"), "total_users"
    )
