"""Command line for the streaming job.

    spark-submit --py-files clickledger.zip clickledger/streaming/job.py --source kafka \
        --clicks kafka.bootstrap.servers=host:9092 subscribe=clicks \
        --checkouts kafka.bootstrap.servers=host:9092 subscribe=checkouts \
        --payload value --tables <folder> --checkpoint <folder>

Source options are passed to the connector as they are. File sources take ``path=<folder>``. With
``--database`` the tables are also appended to a database, with ``--summaries`` the summaries follow each
batch; ``--close-days`` settles and compacts stored days and sets their late events apart, instead of
reading the streams, and ``--expire-days`` then drops older days from the event store.
"""

from __future__ import annotations

import argparse
from datetime import timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickledger.schemas import CHECKOUT_SCHEMA, CLICK_SCHEMA
from clickledger.session import build_session
from clickledger.sources.feeds import decode, read_stream
from clickledger.streaming.attribution import WATERMARK
from clickledger.streaming.late import WatermarkDrops
from clickledger.streaming.pipeline import close_days, start_pipeline, wait
from clickledger.streaming.sinks import jdbc_writer


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="First-click attribution on two event streams")
    parser.add_argument("--source", required=True, help="streaming source format")
    parser.add_argument("--clicks", nargs="+", required=True, metavar="OPTION=VALUE")
    parser.add_argument("--checkouts", nargs="+", required=True, metavar="OPTION=VALUE")
    parser.add_argument("--payload", default="value", help="source column with the JSON record")
    parser.add_argument("--tables", required=True, help="folder of the result tables")
    parser.add_argument("--checkpoint", required=True, help="folder of the query checkpoints")
    parser.add_argument("--window-minutes", type=int, default=60)
    parser.add_argument("--watermark", default=WATERMARK)
    parser.add_argument("--trigger", default="30 seconds")
    parser.add_argument("--database", metavar="URL", help="JDBC address to append the tables to")
    parser.add_argument("--database-options", nargs="+", default=[], metavar="OPTION=VALUE")
    parser.add_argument("--close-days", nargs="+", metavar="YYYY-MM-DD")
    parser.add_argument("--limit", type=int, help="files or records a micro-batch takes at most")
    parser.add_argument("--expire-days", nargs="+", default=[], metavar="YYYY-MM-DD")
    parser.add_argument("--summaries", metavar="FOLDER", help="keep summaries up to date there")
    parser.add_argument("--once", action="store_true", help="process what is there, then end")
    return parser.parse_args(arguments)


def open_feed(
    spark: SparkSession, source: str, options: list[str], payload: str, schema: T.StructType, limit: int | None = None
) -> DataFrame:
    settings = dict(option.split("=", 1) for option in options)
    stream = read_stream(spark, source, settings.pop("path", None), limit=limit, **settings)
    return decode(stream, schema, payload)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.close_days:
        close_days(spark, args.tables, args.close_days, args.expire_days)
        return
    spark.streams.addListener(WatermarkDrops())
    second = None
    if args.database:
        options = dict(option.split("=", 1) for option in args.database_options)
        second = partial(jdbc_writer, args.database, properties=options)
    queries = start_pipeline(
        open_feed(spark, args.source, args.clicks, args.payload, CLICK_SCHEMA, args.limit),
        open_feed(spark, args.source, args.checkouts, args.payload, CHECKOUT_SCHEMA, args.limit),
        args.tables,
        args.checkpoint,
        timedelta(minutes=args.window_minutes),
        args.watermark,
        {"availableNow": True} if args.once else {"processingTime": args.trigger},
        second,
        args.summaries,
    )
    wait(queries, until_all=args.once)


if __name__ == "__main__":
    run(build_session("clickledger-stream", streaming=True), parse_arguments())
