"""The three streaming queries: attribution, raw clicks, raw checkouts."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickledger.operators.first_click import ATTRIBUTION_WINDOW
from clickledger.sources.feeds import valid_checkouts, valid_clicks
from clickledger.sources.tables import raw_checkouts, raw_clicks
from clickledger.plans.rollups import summarising_writer
from clickledger.schemas import EVENT_SCHEMA, RAW_CHECKOUT_SCHEMA, RAW_CLICK_SCHEMA, WINNER_SCHEMA
from clickledger.streaming.attribution import (
    TIME,
    WATERMARK,
    attributing_writer,
    earliest_credits,
    event_stream,
    events_of,
    settle_days,
)
from clickledger.streaming.late import store_late
from clickledger.streaming.sinks import (
    BatchWriter,
    checkpoint_run,
    compact_days,
    each_of,
    ensure_table,
    expire_days,
    first_copies,
    keyed_writer,
    quarantining_writer,
    read_once,
    stored_schema,
)

TRIGGER = {"processingTime": "30 seconds"}

# Gives the writer that a table's batches go to besides the Parquet store, for example a JDBC append.
SecondStore = Callable[[str], BatchWriter]


def start_query(
    stream: DataFrame, writer: BatchWriter, checkpoint: str, name: str, trigger: dict
) -> StreamingQuery:
    """Append-mode query with its own checkpoint folder. A writer error ends the query."""
    return (
        stream.writeStream.queryName(name)
        .foreachBatch(writer)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .trigger(**trigger)
        .start()
    )


def start_attribution(
    clicks: DataFrame,
    checkouts: DataFrame,
    root: str,
    checkpoint: str,
    window: timedelta = ATTRIBUTION_WINDOW,
    delay: str = WATERMARK,
    trigger: dict = TRIGGER,
    second: SecondStore | None = None,
    summaries: str | None = None,
    users: DataFrame | None = None,
) -> StreamingQuery:
    """Current-winner attribution into the batch store under ``root`` and the event store beside it.

    With ``summaries``, a folder, each batch also brings the summaries of its hours up to date, by
    segment too where ``users`` are given.
    """
    spark = clicks.sparkSession
    ensure_table(spark, root, stored_schema(WINNER_SCHEMA))
    ensure_table(spark, events_of(root), stored_schema(EVENT_SCHEMA))
    run = checkpoint_run(spark, checkpoint, "attribution")
    also = each_of(
        second("attributed_checkouts") if second else None,
        summarising_writer(root, summaries, run, users) if summaries else None,
    )
    writer = attributing_writer(root, window, run, also)
    events = event_stream(clicks, checkouts, delay)
    return start_query(events, writer, checkpoint, "attribution", trigger)


def start_raw_clicks(
    clicks: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict = TRIGGER,
    second: SecondStore | None = None,
) -> StreamingQuery:
    """All clicks, late ones included, once per event id; unusable ones in ``<root>_quarantine``."""
    also = second("raw_clicks") if second else None
    return _start_raw(clicks, valid_clicks, raw_clicks, root, checkpoint, "clicks", trigger, also)


def start_raw_checkouts(
    checkouts: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict = TRIGGER,
    second: SecondStore | None = None,
) -> StreamingQuery:
    """All checkouts, late ones included, once per event id; unusable ones in ``<root>_quarantine``."""
    also = second("raw_checkouts") if second else None
    return _start_raw(
        checkouts, valid_checkouts, raw_checkouts, root, checkpoint, "checkouts", trigger, also
    )


def _start_raw(
    stream: DataFrame,
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    shape: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
    name: str,
    trigger: dict,
    also: BatchWriter | None = None,
) -> StreamingQuery:
    schema = shape(split(stream)[0]).schema
    ensure_table(stream.sparkSession, root, stored_schema(schema))
    run = checkpoint_run(stream.sparkSession, checkpoint, name)
    keyed = keyed_writer(root, schema, "event_id", TIME, run)
    valid = each_of(keyed, also)
    writer = quarantining_writer(split, shape, valid, f"{root}_quarantine", run)
    return start_query(stream, writer, checkpoint, name, trigger)


def start_pipeline(
    clicks: DataFrame,
    checkouts: DataFrame,
    tables: str,
    checkpoint: str,
    window: timedelta = ATTRIBUTION_WINDOW,
    delay: str = WATERMARK,
    trigger: dict = TRIGGER,
    second: SecondStore | None = None,
    summaries: str | None = None,
) -> list[StreamingQuery]:
    """Start all three queries on decoded feeds; :func:`wait` for them."""
    return [
        start_attribution(
            valid_clicks(clicks)[0],
            valid_checkouts(checkouts)[0],
            f"{tables}/attributed_checkouts",
            checkpoint,
            window,
            delay,
            trigger,
            second,
            summaries,
        ),
        start_raw_clicks(clicks, f"{tables}/raw_clicks", checkpoint, trigger, second),
        start_raw_checkouts(checkouts, f"{tables}/raw_checkouts", checkpoint, trigger, second),
    ]


def wait(queries: list[StreamingQuery], until_all: bool = False, poll_seconds: float = 1.0) -> None:
    """Block until any of the queries ends, or all of them, then stop the rest of these queries only.

    A failed query raises here, at once in either case.
    """
    try:
        while True:
            ended = [query for query in queries if not query.isActive]
            for query in ended:
                query.awaitTermination()
            if ended and (not until_all or len(ended) == len(queries)):
                return
            time.sleep(poll_seconds)
    finally:
        for query in queries:
            query.stop()


def read_raw_clicks(spark: SparkSession, root: str, days: list[str] | None = None) -> DataFrame:
    """The stored click table, each event once."""
    return read_once(spark, root, RAW_CLICK_SCHEMA, "event_id", TIME, days)


def read_raw_checkouts(spark: SparkSession, root: str, days: list[str] | None = None) -> DataFrame:
    """The stored checkout table, each event once."""
    return read_once(spark, root, RAW_CHECKOUT_SCHEMA, "event_id", TIME, days)


def close_days(spark: SparkSession, tables: str, days: list[str], expired: list[str] = ()) -> None:
    """Settle, compact and look for late events in days that no batch adds to any more.

    ``expired`` names days, settled before, whose events no open day's window reaches: they leave the
    event store, and their credits stay in the settled table only.
    """
    attributed = f"{tables}/attributed_checkouts"
    settle_days(spark, attributed, f"{tables}/attributed_settled", days)
    if days:
        store_late(spark, tables, days)
        compact_days(spark, events_of(attributed), EVENT_SCHEMA, days, TIME, DataFrame.distinct)
        compact_days(spark, attributed, WINNER_SCHEMA, days, "checkout_timestamp", earliest_credits)
    expire_days(spark, events_of(attributed), expired)

    def once(stored: DataFrame) -> DataFrame:
        return first_copies(stored, "event_id", TIME)

    for name, schema in (("raw_clicks", RAW_CLICK_SCHEMA), ("raw_checkouts", RAW_CHECKOUT_SCHEMA)):
        compact_days(spark, f"{tables}/{name}", schema, days, TIME, once)
