"""First-click attribution on two event streams.

Each feed gets a watermark and drops repeated deliveries inside it. Three ways lead on from there:

* current winner (:func:`attributing_writer`): each micro-batch is stored, and its checkouts, and the
  stored checkouts that its clicks can still move, are credited from the stored events of the time
  span in question, without forming pairs. The table is the minimum over the batches: a row appears
  with its batch and can only move to an earlier click.
* pairs (:func:`pair_stream`): the interval join itself, all pairs.
* final winner: a streaming aggregation over the pairs emits each checkout once, after window plus
  watermark.
"""

from __future__ import annotations

import logging
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickledger.functions.times import whole_seconds
from clickledger.operators.first_click import (
    ATTRIBUTION_WINDOW,
    CHECKOUT_FIELDS,
    CLICK_FIELDS,
    attribution_columns,
    first_clicks,
)
from clickledger.schemas import ATTRIBUTED_SCHEMA, EVENT_SCHEMA, WINNER_SCHEMA
from clickledger.streaming.sinks import (
    BatchWriter,
    batch_name,
    read_if_there,
    read_store,
    write_by_date,
)

log = logging.getLogger(__name__)

WATERMARK = "5 minutes"
TIME = "event_timestamp"


def watermarked(feed: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Event-time watermark plus removal of repeated deliveries within it."""
    return feed.withWatermark(TIME, delay).dropDuplicatesWithinWatermark(["event_id"])


def pair_stream(
    clicks: DataFrame,
    checkouts: DataFrame,
    window: timedelta = ATTRIBUTION_WINDOW,
    delay: str = WATERMARK,
) -> DataFrame:
    """Stream-stream interval join of checkouts and the same user's clicks in the window.

    It emits every pair, as an interval join does; where only the first click is wanted,
    :func:`attributing_writer` forms no pairs.
    """
    whole_seconds(window)
    clicks, checkouts = watermarked(clicks, delay), watermarked(checkouts, delay)
    clicks = clicks.select("user_id", TIME, F.struct(*CLICK_FIELDS).alias("click"))
    checkouts = checkouts.select(
        F.col("user_id"),
        F.col("event_id").alias("checkout_id"),
        F.col(TIME).alias("checkout_timestamp"),
        F.col("total_amount").alias("revenue"),
    )
    left, right = checkouts.alias("k"), clicks.alias("c")
    at, click_at = F.col("checkout_timestamp"), F.col(f"c.{TIME}")
    same_user = F.col("k.user_id") == F.col("c.user_id")
    condition = same_user & (click_at <= at) & (click_at >= at - F.lit(window))
    return left.join(right, condition, "inner").select(
        "checkout_id", "k.user_id", "checkout_timestamp", "revenue", "click"
    )


def event_stream(clicks: DataFrame, checkouts: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Both feeds as one stream of EVENT_SCHEMA, repeats and events behind the watermark left out."""
    clicks = watermarked(clicks, delay).select(
        "user_id", TIME, F.struct(*CLICK_FIELDS).alias("click")
    )
    checkouts = watermarked(checkouts, delay).select(
        "user_id", TIME, F.struct(*CHECKOUT_FIELDS).alias("checkout")
    )
    return clicks.unionByName(checkouts, allowMissingColumns=True).select(*EVENT_SCHEMA.names)


def events_of(root: str) -> str:
    """Folder of the event store that goes with an attribution table."""
    return f"{root.rstrip('/')}_events"


def attributing_writer(
    root: str,
    window: timedelta = ATTRIBUTION_WINDOW,
    run: str = "",
    also: BatchWriter | None = None,
) -> BatchWriter:
    """Writer of :func:`event_stream` batches: stores the events, then the credits that they change.

    A batch's checkouts need the clicks of the window before them, and its clicks can move the
    checkouts of the window after them; so the batch is credited together with the stored events of its
    own users from one window before its earliest to one window after its latest event. Only credits
    that involve an event of the batch are stored, one row per checkout at most. The watermark keeps
    batches, and so these spans, near the present. Both stores are laid out by batch, and a replay
    finds the same events and overwrites the same folders. ``also`` gets the changed rows of the
    attribution table, for a second store.
    """
    whole_seconds(window)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(run, batch_id)
        batch = batch.where(F.col("user_id").isNotNull() & F.col(TIME).isNotNull()).persist()
        try:
            first, last = F.min(TIME) - F.lit(window), F.max(TIME) + F.lit(window)
            days = F.sequence(F.to_date(first), F.to_date(last))
            span = batch.agg(first.alias("low"), last.alias("high"), days.alias("days")).first()
            if span.low is None:
                log.info("batch %s: nothing to write to %s", name, root)
                return
            write_by_date(batch, name, events_of(root), TIME)
            near = (
                read_store(spark, events_of(root), EVENT_SCHEMA, span.days)
                .where(F.col(TIME).between(F.lit(span.low), F.lit(span.high)))
                .join(batch.select("user_id").distinct(), "user_id", "left_semi")
            )
            winners = first_clicks(_feed(near, "click"), _feed(near, "checkout"), window)
            new_checkouts = _feed(batch, "checkout").select(F.col("event_id").alias("checkout_id"), F.lit(True).alias("own"))
            new_clicks = _feed(batch, "click").select(F.col("event_id").alias("click_id"), F.lit(True).alias("moved"))
            changed = (
                winners.join(new_checkouts.distinct(), "checkout_id", "left")
                .join(new_clicks.distinct(), F.col("click.event_id") == F.col("click_id"), "left")
                .where("own OR moved")
                .select(*WINNER_SCHEMA.names)
            )
            write_by_date(changed, name, root, "checkout_timestamp")
            if also is not None:
                also(attribution_columns(changed), batch_id)
        finally:
            batch.unpersist()

    return write


def _feed(events: DataFrame, kind: str) -> DataFrame:
    """Clicks or checkouts of an event table, flat."""
    fields = {"click": CLICK_FIELDS, "checkout": CHECKOUT_FIELDS}[kind]
    columns = [F.col(f"{kind}.{c}").alias(c) for c in fields if c != TIME]
    return events.where(F.col(kind).isNotNull()).select("user_id", TIME, *columns)


def first_of_pairs(pairs: DataFrame, *extra: str) -> DataFrame:
    """Earliest click per checkout of a static set of pairs, combined map-side."""
    kept = ["user_id", "checkout_timestamp", "revenue", *extra]
    return (
        pairs.groupBy("checkout_id")
        .agg(F.min(F.struct("click", *kept)).alias("m"))
        .select("checkout_id", *[f"m.{name}" for name in kept], "m.click")
    )


def earliest_credits(stored: DataFrame) -> DataFrame:
    """One stored credit per checkout, with the time it was stored: what readers of the store count."""
    return first_of_pairs(stored, "created_at").select(*WINNER_SCHEMA.names, "created_at")


def current_winners(spark: SparkSession, root: str, days: list[str] | None = None) -> DataFrame:
    """Attribution table over all stored batches: the earliest click any of them found.

    ``processed_at`` tells when the winning batch was stored. ``days`` limits the table to checkouts
    of those days.
    """
    stored = read_store(spark, root, WINNER_SCHEMA, days).withColumnRenamed("created_at", "processed_at")
    return attribution_columns(first_of_pairs(stored, "processed_at"), "processed_at")


def settle_days(spark: SparkSession, root: str, table: str, days: list[str]) -> None:
    """Rewrite the given checkout days of the settled table from the batch store.

    Once the watermark has passed a day no batch adds to it, so its rows can be merged once and read
    without the reduction. Running it again for a day gives the same folders.
    """
    winners = current_winners(spark, root, days)
    (
        winners.withColumn("event_date", F.to_date("checkout_timestamp"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(table)
    )


def read_attributed(
    spark: SparkSession, root: str, table: str | None = None, open_days: list[str] = ()
) -> DataFrame:
    """Attribution table: open days from the batch store at ``root``, all others as settled in ``table``.

    Without a settled table every day is read from the batch store.
    """
    day = T.StructField("event_date", T.DateType())
    settled = read_if_there(spark, table, T.StructType(ATTRIBUTED_SCHEMA.fields + [day])) if table else None
    if settled is None:
        return current_winners(spark, root)
    closed = settled.where(~F.col("event_date").isin([date.fromisoformat(d) for d in open_days]))
    return closed.drop("event_date").unionByName(current_winners(spark, root, list(open_days)))


def final_winners(pairs: DataFrame) -> DataFrame:
    """Streaming aggregation to one row per checkout, emitted when no earlier click can come."""
    winners = pairs.groupBy("checkout_id", "user_id", "checkout_timestamp", "revenue").agg(
        F.min("click").alias("click")
    )
    return attribution_columns(winners)
