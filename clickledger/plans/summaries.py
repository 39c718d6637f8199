"""Stored summary tables and their refresh."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.functions.measures import mean, total
from clickledger.functions.times import hour_of
from clickledger.plans.reports import category_totals
from clickledger.sources.versioned import publish, read_version


def mv_revenue_by_source(attributed: DataFrame) -> DataFrame:
    """Revenue per hour and traffic source, newest hour and largest revenue first."""
    return (
        attributed.groupBy(hour_of(attributed, "checkout_timestamp").alias("hour"), "traffic_source")
        .agg(
            F.count("*").alias("checkout_count"),
            total("revenue").alias("total_revenue"),
            mean("revenue").alias("avg_revenue"),
            mean("attribution_window_seconds").alias("avg_attribution_window"),
        )
        .orderBy(F.col("hour").desc_nulls_first(), F.col("total_revenue").desc_nulls_first())
    )


def mv_category_performance(attributed: DataFrame) -> DataFrame:
    return category_totals(attributed).orderBy(F.col("total_revenue").desc_nulls_first())


def mv_device_analysis(attributed: DataFrame) -> DataFrame:
    seconds = "attribution_window_seconds"
    minutes = F.sum(seconds).cast("double") / F.count(seconds) / 60
    return (
        attributed.groupBy("device_type")
        .agg(
            F.count("*").alias("conversion_count"),
            total("revenue").alias("total_revenue"),
            mean("revenue").alias("avg_order_value"),
            F.round(minutes, 6).alias("avg_time_to_purchase_minutes"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first())
    )


SUMMARIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "mv_revenue_by_source": mv_revenue_by_source,
    "mv_category_performance": mv_category_performance,
    "mv_device_analysis": mv_device_analysis,
}


def refresh_all(attributed: DataFrame, root: str) -> str:
    """Recompute the summaries as one new version; readers keep the old ones until all are there."""
    builds = {name: partial(build, attributed) for name, build in SUMMARIES.items()}
    return publish(attributed.sparkSession, root, builds)


def read_summary(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Latest published version of a summary."""
    return read_version(spark, root, name)
