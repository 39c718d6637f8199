"""Summaries kept up batch by batch: partial aggregates by hour, and user bitmaps by day.

A batch of attribution adds checkouts and may move earlier ones to another click, so its own sums cannot
simply be added. Instead the hours it touched are aggregated anew from the stored credits of their days,
and replace exactly their folders: ``cells`` by hour, source, category and device; ``customers`` and
``segments`` by day, whose users are bitmaps, so that distinct counts merge exactly over days. Reports
read these small tables only. A replayed batch rewrites the same folders.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.operators.bitmaps import add_numbers, bitmaps_of, merged_count
from clickledger.plans.summaries import SUMMARIES
from clickledger.streaming.attribution import current_winners
from clickledger.streaming.sinks import BatchWriter, batch_name

SECONDS = "attribution_window_seconds"

_SUMS = "rows BIGINT, revenue DECIMAL(20,2), revenue_rows BIGINT, seconds BIGINT, seconds_rows BIGINT"
SCHEMAS: dict[str, str] = {
    "cells": "hour TIMESTAMP, traffic_source STRING, attributed_category STRING, device_type STRING, "
    f"{_SUMS}, event_date DATE, event_hour INT",
    "customers": "attributed_category STRING, bucket BIGINT, bitmap BINARY, event_date DATE",
    "segments": f"customer_segment STRING, {_SUMS}, event_date DATE",
    "segment_customers": "customer_segment STRING, bucket BIGINT, bitmap BINARY, event_date DATE",
}


def partial_sums(attributed: DataFrame, *by: str | Column) -> DataFrame:
    """Sums and counts that add up to the averages of any coarser group."""
    return attributed.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.sum("revenue").alias("revenue"),
        F.count("revenue").alias("revenue_rows"),
        F.sum(SECONDS).alias("seconds"),
        F.count(SECONDS).alias("seconds_rows"),
    )


def touched_hours(credits: DataFrame) -> list[tuple[datetime, date]]:
    """The hours of some credits' checkouts and their days; one row an hour comes to the driver."""
    hour, day = F.date_trunc("hour", "checkout_timestamp").alias("hour"), F.to_date("checkout_timestamp").alias("day")
    return [tuple(row) for row in credits.select(hour, day).where("hour IS NOT NULL").distinct().collect()]


def refresh_hours(
    spark: SparkSession,
    store: str,
    root: str,
    hours: Iterable[tuple[datetime, date]],
    batch_id: str,
    users: DataFrame | None = None,
) -> None:
    """Aggregate the given hours of the attribution store anew; only their days' folders are read.

    With ``users(user_id, customer_segment)`` segments are kept too, by the segment that a user has then;
    after a change of segments refresh all hours.
    """
    hours = sorted(hours)
    if not hours:
        return
    days = sorted({day for _, day in hours})
    winners = current_winners(spark, store, days).withColumn("event_date", F.to_date("checkout_timestamp"))
    winners = winners.withColumn("hour", F.date_trunc("hour", "checkout_timestamp")).persist()
    try:
        touched = winners.where(F.col("hour").isin([hour for hour, _ in hours]))
        cells = partial_sums(touched, "hour", "traffic_source", "attributed_category", "device_type", "event_date")
        _replace(cells.withColumn("event_hour", F.hour("hour")), root, "cells", "event_date", "event_hour")
        numbers = add_numbers(spark, f"{root}/user_numbers", winners, batch_id)
        numbered = winners.select("event_date", "user_id", "attributed_category").join(numbers, "user_id")
        _replace(bitmaps_of(numbered, "event_date", "attributed_category"), root, "customers", "event_date")
        if users is not None:
            sorted_out = winners.join(users.select("user_id", "customer_segment"), "user_id")
            _replace(partial_sums(sorted_out, "event_date", "customer_segment"), root, "segments", "event_date")
            numbered = sorted_out.select("event_date", "user_id", "customer_segment").join(numbers, "user_id")
            _replace(bitmaps_of(numbered, "event_date", "customer_segment"), root, "segment_customers", "event_date")
    finally:
        winners.unpersist()


def _replace(df: DataFrame, root: str, name: str, *folders: str) -> None:
    schema = df.sparkSession.createDataFrame([], SCHEMAS[name]).schema
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    small = df.select(*columns).repartition(*folders)  # one file a folder
    small.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(f"{root}/{name}")


def summarising_writer(store: str, root: str, run: str = "", users: DataFrame | None = None) -> BatchWriter:
    """Writer of changed credits, after they are stored: brings the summaries of their hours up to date."""

    def write(changed: DataFrame, batch_id: int) -> None:
        refresh_hours(changed.sparkSession, store, root, touched_hours(changed), batch_name(run, batch_id), users)

    return write


def read_part(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}")


def _mean(total: str, rows: str) -> Column:
    return F.round(F.sum(total).cast("double") / F.sum(rows), 6)


def _revenue() -> Column:
    return F.sum("revenue").cast("decimal(20,2)")


def revenue_by_source(spark: SparkSession, root: str) -> DataFrame:
    """As ``mv_revenue_by_source``, added up from the cells."""
    return (
        read_part(spark, root, "cells")
        .groupBy("hour", "traffic_source")
        .agg(
            F.sum("rows").alias("checkout_count"),
            _revenue().alias("total_revenue"),
            _mean("revenue", "revenue_rows").alias("avg_revenue"),
            _mean("seconds", "seconds_rows").alias("avg_attribution_window"),
        )
        .orderBy(F.col("hour").desc_nulls_first(), F.col("total_revenue").desc_nulls_first())
    )


def category_performance(spark: SparkSession, root: str) -> DataFrame:
    """As ``mv_category_performance``; customers are counted from the days' merged bitmaps."""
    sums = (
        read_part(spark, root, "cells")
        .groupBy("attributed_category")
        .agg(
            F.sum("rows").alias("conversion_count"),
            _revenue().alias("total_revenue"),
            _mean("revenue", "revenue_rows").alias("avg_order_value"),
        )
    )
    people = merged_count(read_part(spark, root, "customers"), "unique_customers", "attributed_category")
    people = people.withColumnRenamed("attributed_category", "of")
    joined = sums.join(people, F.col("attributed_category").eqNullSafe(F.col("of")), "left").drop("of")
    return joined.fillna(0, ["unique_customers"]).orderBy(F.col("total_revenue").desc_nulls_first())


def device_analysis(spark: SparkSession, root: str) -> DataFrame:
    """As ``mv_device_analysis``, added up from the cells."""
    minutes = F.sum("seconds").cast("double") / F.sum("seconds_rows") / 60
    return (
        read_part(spark, root, "cells")
        .groupBy("device_type")
        .agg(
            F.sum("rows").alias("conversion_count"),
            _revenue().alias("total_revenue"),
            _mean("revenue", "revenue_rows").alias("avg_order_value"),
            F.round(minutes, 6).alias("avg_time_to_purchase_minutes"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_first())
    )


def segment_performance(spark: SparkSession, root: str) -> DataFrame:
    """Orders, customers and revenue per segment, as the report of that name, from days' sums and bitmaps."""
    sums = (
        read_part(spark, root, "segments")
        .groupBy("customer_segment")
        .agg(
            F.sum("rows").alias("total_orders"),
            _revenue().alias("total_revenue"),
            _mean("revenue", "revenue_rows").alias("avg_order_value"),
        )
    )
    people = merged_count(read_part(spark, root, "segment_customers"), "active_customers", "customer_segment")
    people = people.withColumnRenamed("customer_segment", "of")
    joined = sums.join(people, F.col("customer_segment").eqNullSafe(F.col("of"))).drop("of")
    each = F.round(F.col("total_revenue").cast("double") / F.nullif("active_customers", F.lit(0)), 6)
    columns = ["customer_segment", "total_orders", "active_customers", "total_revenue", "avg_order_value"]
    return joined.select(*columns, each.alias("revenue_per_customer")).orderBy(F.col("total_revenue").desc_nulls_first())


#: The stored summaries by the names of their full builds.
MERGED = dict(zip(SUMMARIES, (revenue_by_source, category_performance, device_analysis)))
