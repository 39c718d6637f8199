"""One row per event id in batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame


def dedup_events(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Drop repeated deliveries; copies are combined map-side before the shuffle."""
    return events.dropDuplicates([key])
