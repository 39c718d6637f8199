"""Events behind the watermark: kept in tables of their own, counted, and told apart in a report.

The attribution drops what comes later than its watermark allows; the raw tables keep it. So the late
events of a day are the raw ones that the attribution's event store does not hold.
"""

from __future__ import annotations

import logging
from collections import Counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from clickledger.schemas import EVENT_SCHEMA, RAW_CHECKOUT_SCHEMA, RAW_CLICK_SCHEMA
from clickledger.streaming.attribution import TIME, current_winners, events_of
from clickledger.streaming.sinks import ensure_table, read_once, read_store, stored_schema, write_by_date

log = logging.getLogger(__name__)

_FEEDS = {"clicks": ("click", RAW_CLICK_SCHEMA), "checkouts": ("checkout", RAW_CHECKOUT_SCHEMA)}


class WatermarkDrops(StreamingQueryListener):
    """Counts by query name the rows that stateful operators dropped as late, repeats among them."""

    def __init__(self):
        self.rows: Counter[str] = Counter()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        dropped = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        if dropped:
            self.rows[event.progress.name] += dropped
            log.warning("%s: %s rows behind the watermark", event.progress.name, dropped)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def passed_ids(spark: SparkSession, tables: str, feed: str, days: list | None = None) -> DataFrame:
    """``event_id`` of a feed's events that the attribution took."""
    kind = _FEEDS[feed][0]
    store = read_store(spark, events_of(f"{tables}/attributed_checkouts"), EVENT_SCHEMA, days)
    return store.where(F.col(kind).isNotNull()).select(F.col(f"{kind}.event_id").alias("event_id"))


def late_events(spark: SparkSession, tables: str, feed: str, days: list | None = None) -> DataFrame:
    """Stored raw ``clicks`` or ``checkouts`` that came behind the watermark, each once."""
    raw = read_once(spark, f"{tables}/raw_{feed}", _FEEDS[feed][1], "event_id", TIME, days)
    return raw.join(passed_ids(spark, tables, feed, days), "event_id", "left_anti").select(*_FEEDS[feed][1].names)


def store_late(spark: SparkSession, tables: str, days: list[str]) -> dict[str, int]:
    """Keep the late events of closed days in ``late_clicks`` and ``late_checkouts``; returns their counts.

    Each day is a folder of its own in a table written by day, so that a second call changes nothing.
    """
    counts = dict.fromkeys(_FEEDS, 0)
    for feed, (_, schema) in _FEEDS.items():
        root = f"{tables}/late_{feed}"
        ensure_table(spark, root, stored_schema(schema))
        counted = Observation()
        late = late_events(spark, tables, feed, days).observe(counted, F.count("*").alias("rows"))
        write_by_date(late, "late", root, TIME)
        counts[feed] = counted.get["rows"]
        log.info("%s late %s in %s days", counts[feed], feed, len(days))
    return counts


def read_late(spark: SparkSession, tables: str, feed: str, days: list | None = None) -> DataFrame:
    """The stored late events of a feed."""
    schema = _FEEDS[feed][1]
    return read_store(spark, f"{tables}/late_{feed}", schema, days).select(*schema.names)


def checkout_outcomes(spark: SparkSession, tables: str) -> DataFrame:
    """All stored checkouts by what became of them: ``attributed``, ``unmatched`` or ``late``."""
    raw = read_once(spark, f"{tables}/raw_checkouts", RAW_CHECKOUT_SCHEMA, "event_id", TIME)
    credited = current_winners(spark, f"{tables}/attributed_checkouts")
    credited = credited.select(F.col("checkout_id").alias("event_id"), F.lit(True).alias("credited"))
    passed = passed_ids(spark, tables, "checkouts").distinct().withColumn("passed", F.lit(True))
    outcome = F.when(F.col("credited"), "attributed").when(F.col("passed"), "unmatched").otherwise("late")
    joined = raw.join(credited, "event_id", "left").join(passed, "event_id", "left")
    return (
        joined.groupBy(outcome.alias("outcome"))
        .agg(F.count("*").alias("checkouts"), F.sum("total_amount").alias("revenue"))
        .orderBy("outcome")
    )
