"""Exact distinct counts that merge: bitmaps over the numbers that users get when first seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NUMBERS_SCHEMA = "user_id STRING, number BIGINT, batch_id STRING"


def read_numbers(spark: SparkSession, root: str) -> DataFrame:
    """``user_id, number`` of all users that have one."""
    return spark.read.schema(NUMBERS_SCHEMA).parquet(root).select("user_id", "number")


def add_numbers(spark: SparkSession, root: str, users: DataFrame, batch_id: str) -> DataFrame:
    """Number the users that have no number yet, from the highest on, and return all numbers.

    New users are dealt by ranges of their id, numbered inside their range, and moved up by what lies in
    the ranges before, so no task sees them all. Numbers follow the order of ids and what other batches
    hold; a batch that is replayed overwrites its own folder with the same numbers.
    """
    spark.createDataFrame([], NUMBERS_SCHEMA).write.mode("ignore").partitionBy("batch_id").parquet(root)
    stored = spark.read.schema(NUMBERS_SCHEMA).parquet(root).where(F.col("batch_id") != batch_id)
    fresh = users.select("user_id").where(F.col("user_id").isNotNull()).distinct()
    fresh = fresh.join(stored.select("user_id"), "user_id", "left_anti")
    dealt = fresh.repartitionByRange("user_id").sortWithinPartitions("user_id")
    dealt = dealt.withColumn("place", F.monotonically_increasing_id())
    path = f"{root}_ranges/{batch_id}"
    dealt.write.mode("overwrite").parquet(path)
    dealt = spark.read.schema("user_id STRING, place BIGINT").parquet(path)
    dealt = dealt.select(
        "user_id", F.shiftright("place", 33).alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("inner")
    )
    sizes = dealt.groupBy("part").agg(F.count("*").alias("rows"))  # one row a range
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    last = stored.agg(F.coalesce(F.max("number"), F.lit(0)).alias("last")).scalar()
    numbered = dealt.join(F.broadcast(sizes), "part").select(
        "user_id", (last + F.col("before") + F.col("inner") + 1).alias("number"), F.lit(batch_id).alias("batch_id")
    )
    numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(root)
    return read_numbers(spark, root)


def bitmaps_of(numbered: DataFrame, *by: str) -> DataFrame:
    """``by..., bucket, bitmap``: the numbers of each group as one bitmap for each 32,768 numbers."""
    return numbered.groupBy(*by, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    )


def merged_count(bitmaps: DataFrame, name: str, *by: str) -> DataFrame:
    """``by..., name``: how many different numbers the bitmaps of each group hold together."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    return merged.groupBy(*by).agg(F.sum("n").alias(name))
