"""Named queries over a folder of the shared test tables.

Every query derives its feeds from whole tables. :func:`comparable` only fits result types to what
other engines return: exact decimals become doubles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickledger.operators.click_counts import clicks_in_window
from clickledger.operators.dedup import dedup_events
from clickledger.operators.first_click import ATTRIBUTION_WINDOW, first_click_attribution, first_clicks
from clickledger.operators.interval_join import attribution_pairs
from clickledger.plans import reports, rollups
from clickledger.plans.quality import audit_constraints
from clickledger.plans.sql_reports import register_reports
from clickledger.plans.stats import table_sample, table_stats
from clickledger.plans.summaries import SUMMARIES, read_summary, refresh_all
from clickledger.schemas import (
    CHECKOUT_SCHEMA,
    CLICK_SCHEMA,
    RAW_CHECKOUT_SCHEMA,
    RAW_CLICK_SCHEMA,
    RULES,
    WINNER_SCHEMA,
    TableRules,
)
from clickledger.session import shared_dir
from clickledger.sources import colocated, feeds, tables
from clickledger.sources import shop_events as shop
from clickledger.streaming import late
from clickledger.streaming.attribution import final_winners, pair_stream, read_attributed
from clickledger.streaming.pipeline import start_attribution, start_raw_checkouts, start_raw_clicks, wait
from clickledger.streaming.sinks import (
    ensure_table,
    keyed_writer,
    read_recent,
    read_store,
    stored_schema,
    write_by_date,
)

Query = Callable[[SparkSession, str], DataFrame]

HOUR = ATTRIBUTION_WINDOW
DAY = timedelta(hours=24)
MONTH = timedelta(days=30)
USERS_AS_OF = date(2024, 1, 31)
ONCE = {"availableNow": True}


def comparable(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def attributed(
    spark: SparkSession, folder: str, window: timedelta = HOUR, last_hours: float | None = None
) -> DataFrame:
    """Attribution over the folder's feeds; ``last_hours`` prunes both scans for recent reports."""
    since = None
    if last_hours is not None:
        clock, span = shop.clock(spark, folder), timedelta(hours=last_hours)

        def since(back: timedelta) -> F.Column:
            return clock(span + back)

    return first_click_attribution(
        shop.clicks(spark, folder), shop.checkouts(spark, folder), window, since
    )


def on_attributed(report: Callable[[DataFrame], DataFrame], window: timedelta = HOUR) -> Query:
    return lambda spark, folder: report(attributed(spark, folder, window))


# --- ingest -------------------------------------------------------------------------------------


def wire_time(ts: str) -> F.Column:
    """ISO text with a Z, the fraction absent when it is zero, as producers send it."""
    return F.concat(F.replace(F.col(ts).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def utc_clock(df: DataFrame) -> DataFrame:
    """Instants back to zone-less UTC times, as the test tables hold them."""
    return df.withColumn(
        "event_timestamp", F.convert_timezone(None, F.lit("UTC"), F.col("event_timestamp"))
    )


def click_payloads(spark: SparkSession, folder: str) -> DataFrame:
    clicks = shop.clicks(spark, folder)
    record = clicks.withColumns(
        {
            "timestamp": wire_time("event_timestamp"),
            "page_url": F.concat(F.lit("/products/"), F.col("product_id")),
        }
    ).drop("event_timestamp")
    return record.select(F.to_json(F.struct("*")).cast("binary").alias("data"))


def parse_clicks(spark: SparkSession, folder: str) -> DataFrame:
    decoded = feeds.decode(click_payloads(spark, folder), CLICK_SCHEMA)
    valid, _ = feeds.valid_clicks(decoded)
    return utc_clock(valid).drop("timestamp")


def checkout_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """One message per order with all its lines as items, so as many as a basket holds."""
    part = shop.table(spark, folder, "part").select("p_partkey", "p_name")
    lines = shop.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_quantity"
    )
    orders = shop.table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"
    )
    item = F.struct(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    baskets = (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey")
        .agg(F.collect_list(item).alias("items"))
    )
    countries = F.array(*map(F.lit, shop.COUNTRIES))
    country = F.element_at(countries, (F.col("o_custkey") % len(shop.COUNTRIES) + 1).cast("int"))
    postal = F.lpad((F.col("o_custkey") % 100_000).cast("string"), 5, "0")
    record = baskets.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").cast("string").alias("event_id"),
        F.expr(shop.user_key("o_custkey")).alias("user_id"),
        wire_time("o_orderdate").alias("timestamp"),
        "items",
        F.col("o_totalprice").alias("total_amount"),
        F.struct(country.alias("country"), postal.alias("postal_code")).alias("shipping_address"),
    )
    return record.select(F.to_json(F.struct("*")).cast("binary").alias("data"))


def parse_checkouts_nested(spark: SparkSession, folder: str) -> DataFrame:
    decoded = feeds.decode(checkout_payloads(spark, folder), CHECKOUT_SCHEMA)
    valid, _ = feeds.valid_checkouts(decoded)

    def over_items(kind: str, field: Callable[[F.Column], F.Column]) -> F.Column:
        zero = F.lit(0).cast(kind)
        return F.aggregate("items", zero, lambda total, item: (total + field(item)).cast(kind))

    quantity = over_items("bigint", lambda item: item.quantity.cast("bigint"))
    price = over_items("decimal(22,2)", lambda item: item.price.cast("decimal(12,2)"))
    return comparable(
        utc_clock(valid).select(
            "event_id",
            "user_id",
            "event_timestamp",
            "total_amount",
            F.size("items").cast("bigint").alias("item_count"),
            quantity.alias("total_quantity"),
            price.alias("items_price"),
        )
    )


def shipped_by_country(spark: SparkSession, folder: str) -> DataFrame:
    """Checkouts by a field that their schema does not know, read from the stored records."""
    path = f"{fresh_root(spark, 'open')}/checkouts"
    valid, _ = feeds.valid_checkouts(feeds.decode(checkout_payloads(spark, folder), CHECKOUT_SCHEMA, keep="payload"))
    stored = valid.select("event_id", "total_amount", "payload")
    stored.write.parquet(path)
    stored = spark.read.schema(stored.schema).parquet(path)
    return comparable(
        stored.groupBy(feeds.open_field("$.shipping_address.country", "string").alias("country")).agg(
            F.count("*").alias("checkouts"),
            F.count_distinct(feeds.open_field("$.shipping_address.postal_code", "string")).alias("postal_codes"),
            F.count(feeds.open_field("$.shipping_address.street", "string")).alias("streets"),
            F.sum("total_amount").alias("revenue"),
        )
    )


def repeated_events(spark: SparkSession, folder: str) -> DataFrame:
    events = shop.table(spark, folder, "events")
    return events.unionAll(events)


# --- reports ------------------------------------------------------------------------------------


def hourly_revenue(hours: float) -> Query:
    return lambda spark, folder: reports.hourly_revenue(
        attributed(spark, folder, last_hours=hours), hours, shop.clock(spark, folder)
    )


def segment_performance(spark: SparkSession, folder: str) -> DataFrame:
    return reports.segment_performance(attributed(spark, folder), shop.users(spark, folder))


def click_to_checkout_rate(spark: SparkSession, folder: str) -> DataFrame:
    return reports.click_to_checkout_rate(
        shop.clicks(spark, folder),
        shop.checkouts(spark, folder),
        as_of=shop.clock(spark, folder),
    )


def clicks_per_checkout(window: timedelta) -> Query:
    return lambda spark, folder: reports.clicks_per_checkout(
        shop.clicks(spark, folder), shop.checkouts(spark, folder), window
    )


def click_counts(window: timedelta) -> Query:
    return lambda spark, folder: clicks_in_window(
        shop.clicks(spark, folder), shop.checkouts(spark, folder), window
    )


def pairs(window: timedelta) -> Query:
    return lambda spark, folder: attribution_pairs(
        shop.clicks(spark, folder), shop.checkouts(spark, folder), window
    )


def written_raw(feed: DataFrame, root: str, schema: T.StructType) -> None:
    """One batch of a feed through the keyed sink, with instants for times."""
    timed = feed.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
    keyed_writer(root, schema, "event_id", "event_timestamp")(timed, 0)


def stored_pairs_of_a_payment(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of the last day's PayPal checkouts; their days prune the stored clicks while the query runs."""
    root, raw = fresh_root(spark, "stored"), raw_tables(spark, folder)
    written_raw(raw["raw_clicks"], f"{root}/raw_clicks", RAW_CLICK_SCHEMA)
    written_raw(raw["raw_checkouts"], f"{root}/raw_checkouts", RAW_CHECKOUT_SCHEMA)
    since = shop.clock(spark, folder)(DAY).cast("timestamp")
    checkouts = read_recent(spark, f"{root}/raw_checkouts", RAW_CHECKOUT_SCHEMA, "event_id", "event_timestamp", since)
    clicks = read_store(spark, f"{root}/raw_clicks", RAW_CLICK_SCHEMA)
    pairs = attribution_pairs(clicks, checkouts.where("payment_method = 'paypal'"), DAY, day="event_date")
    return zone_less(pairs)


def stored_timeline(spark: SparkSession, folder: str) -> str:
    """The feeds as a catalog table bucketed by user and slot; its name."""
    name, buckets = f"timeline_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{fresh_root(spark, 'timeline')}/events"
    colocated.write_timeline(shop.clicks(spark, folder), shop.checkouts(spark, folder), name, path, buckets)
    return name


def colocated_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The segment report over bucketed events and users."""
    name, buckets = f"users_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    colocated.write_users(shop.users(spark, folder), name, f"{fresh_root(spark, 'users')}/users", buckets)
    credits = colocated.first_click_attribution(spark, stored_timeline(spark, folder))
    return colocated.segment_performance(credits, spark.table(name))


def stored_click_to_checkout_rate(spark: SparkSession, folder: str) -> DataFrame:
    """The rate over stored raw tables, of which only the days and times in question are read."""
    root = f"{shared_dir(spark)}/stored-{uuid.uuid4().hex}"
    clock = shop.clock(spark, folder)

    def stored(feed: DataFrame, name: str, schema: T.StructType) -> DataFrame:
        written_raw(feed, f"{root}/{name}", schema)
        return read_recent(spark, f"{root}/{name}", schema, "event_id", "event_timestamp", clock(HOUR).cast("timestamp"))

    raw = raw_tables(spark, folder)
    return reports.click_to_checkout_rate(
        stored(raw["raw_clicks"], "raw_clicks", RAW_CLICK_SCHEMA),
        stored(raw["raw_checkouts"], "raw_checkouts", RAW_CHECKOUT_SCHEMA),
        hours=HOUR.total_seconds() / 3600,
        as_of=lambda back: clock(back).cast("timestamp"),
    )


def pipeline_health(hours: float) -> Query:
    return lambda spark, folder: reports.pipeline_health(
        shop.clicks(spark, folder),
        shop.checkouts(spark, folder),
        attributed(spark, folder, last_hours=hours),
        hours,
        shop.clock(spark, folder),
    )


# --- reports called from SQL --------------------------------------------------------------------


def sql_report(call: str) -> Query:
    """A report called by name in SQL; ``{clock}`` in the call is the time of the latest event."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables.register_views(
            raw_clicks=shop.clicks(spark, folder),
            raw_checkouts=shop.checkouts(spark, folder),
            attributed_checkouts=attributed(spark, folder),
            users=shop.users(spark, folder),
        )
        register_reports(spark)
        latest = shop.table(spark, folder, "events").agg(F.max("ts").alias("ts")).first().ts
        return spark.sql(f"SELECT * FROM {call.format(clock=f"TIMESTAMP_NTZ'{latest}'")}")

    return query


# --- tables -------------------------------------------------------------------------------------


def users_dimension(spark: SparkSession, folder: str) -> DataFrame:
    numbers = shop.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("i"),
        (F.col("c_custkey") % 731).cast("int").alias("days_registered"),
        F.col("c_acctbal").alias("lifetime_value"),
    )
    return tables.users_dimension(numbers, USERS_AS_OF, shop.USER_DIGITS)


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "raw_clicks": tables.raw_clicks(shop.clicks(spark, folder)),
        "raw_checkouts": tables.raw_checkouts(shop.checkouts(spark, folder)),
    }


def stored_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return raw_tables(spark, folder) | {"attributed_checkouts": attributed(spark, folder)}


def all_table_samples(spark: SparkSession, folder: str) -> DataFrame:
    clicks, checkouts, winners = stored_tables(spark, folder).items()

    def sample(named: tuple[str, DataFrame], key: str, time: str) -> DataFrame:
        name, table = named
        return table_sample(table, key).select(
            F.lit(name).alias("table_name"),
            F.col(key).alias("row_key"),
            "user_id",
            F.col(time).alias("event_timestamp"),
        )

    return (
        sample(clicks, "event_id", "event_timestamp")
        .unionAll(sample(checkouts, "event_id", "event_timestamp"))
        .unionAll(sample(winners, "checkout_id", "checkout_timestamp"))
    )


def stored_attribution(spark: SparkSession, folder: str) -> DataFrame:
    """Attribution written once to the shared folder, for queries that read it several times."""
    path = f"{shared_dir(spark)}/attributed-{uuid.uuid4().hex}"
    winners = tables.with_load_time(attributed(spark, folder), "processed_at")
    winners.write.parquet(path)
    return spark.read.schema(winners.schema).parquet(path)


def audit(spark: SparkSession, folder: str) -> DataFrame:
    """All stored tables and summaries, and a feed with repeats that breaks a rule of every kind."""
    winners = stored_attribution(spark, folder)
    checked = raw_tables(spark, folder)
    checked |= {"attributed_checkouts": winners, "users": users_dimension(spark, folder)}
    checked |= {name: build(winners) for name, build in SUMMARIES.items()}
    named = {name: (df, RULES[name]) for name, df in checked.items()}
    feed = repeated_events(spark, folder)
    feed = feed.withColumn("user_id", F.when(F.col("user_id") % 7 > 0, F.col("user_id")))
    feed = feed.withColumn("amount", F.col("value") * 1e6)
    feed_rules = TableRules(
        key=("event_id",),
        required=("event_id", "user_id", "ts", "session_id"),
        max_length={"event_type": 5},
        money=("amount",),
    )
    named["event_feed"] = (feed, feed_rules)
    return audit_constraints(named)


def refreshed_summary(spark: SparkSession, folder: str) -> DataFrame:
    root = f"{shared_dir(spark)}/summaries-{uuid.uuid4().hex}"
    refresh_all(stored_attribution(spark, folder), root)
    return read_summary(spark, root, "mv_revenue_by_source")


# --- streaming ----------------------------------------------------------------------------------


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """One state partition per core: a streaming query keeps the number it is started with."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def zone_less(df: DataFrame) -> DataFrame:
    """Instants as the zone-less times of the test tables."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, k in kinds.items() if k == T.TimestampType()})


def delivered(spark: SparkSession, folder: str, root: str, closing: bool = False) -> tuple[DataFrame, DataFrame]:
    """Clicks and checkouts of the whole event table, as a stream of several deliveries."""
    shop.deliver(spark, folder, f"{root}/feed", closing)
    events = shop.delivered_stream(spark, f"{root}/feed")
    return shop.shape_clicks(events), shop.shape_checkouts(events)


def fresh_root(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def streamed_attribution(window: timedelta) -> Query:
    """The deliveries through the attribution and its stores."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = fresh_root(spark, "attribution")
        feeds_of = delivered(spark, folder, root)
        with state_partitions(spark):
            query = start_attribution(*feeds_of, f"{root}/table", f"{root}/checkpoint", window, shop.DELAY, ONCE)
        query.awaitTermination()
        return comparable(zone_less(read_attributed(spark, f"{root}/table").drop("processed_at")))

    return query


def streamed_raw(which: int, start: Callable, stored: Callable) -> Query:
    """The deliveries of one feed, through its keyed sink."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = fresh_root(spark, "raw")
        feed = delivered(spark, folder, root)[which]
        with state_partitions(spark):
            query = start(feed, f"{root}/table", f"{root}/checkpoint", ONCE)
        query.awaitTermination()
        columns = stored(feed).schema
        return comparable(zone_less(read_store(spark, f"{root}/table", columns).select(*columns.names)))

    return query


def streamed_pairs(final: bool) -> Query:
    """The deliveries through the stream-stream join; ``final`` keeps the winner of each closed window."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = fresh_root(spark, "pairs")
        clicks, checkouts = delivered(spark, folder, root, closing=final)
        pairs = pair_stream(clicks, checkouts, delay=shop.DELAY)
        if final:
            out = final_winners(pairs).drop("processed_at")
        else:
            out = pairs.withColumn("click_id", F.col("click.event_id")).drop("click")
        with state_partitions(spark):
            query = (
                out.writeStream.format("parquet")
                .option("path", f"{root}/table")
                .option("checkpointLocation", f"{root}/checkpoint")
                .outputMode("append")
                .trigger(**ONCE)
                .start()
            )
        query.awaitTermination()
        return comparable(zone_less(spark.read.schema(out.schema).parquet(f"{root}/table")))

    return query


def checkout_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """What became of all checkouts of the deliveries: attributed, unmatched, or behind the watermark."""
    root = fresh_root(spark, "outcomes")
    clicks, checkouts = delivered(spark, folder, root)
    with state_partitions(spark):
        started = [
            start_attribution(
                clicks, checkouts, f"{root}/attributed_checkouts", f"{root}/checkpoint", HOUR, shop.DELAY, ONCE
            ),
            start_raw_checkouts(checkouts, f"{root}/raw_checkouts", f"{root}/checkpoint", ONCE),
        ]
    wait(started, until_all=True)
    return comparable(late.checkout_outcomes(spark, root))


def incremental_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The hourly summary as the batches of the deliveries left it."""
    root = fresh_root(spark, "rollups")
    feeds_of = delivered(spark, folder, root)
    with state_partitions(spark):
        query = start_attribution(
            *feeds_of, f"{root}/table", f"{root}/checkpoint", HOUR, shop.DELAY, ONCE, summaries=f"{root}/summaries"
        )
    query.awaitTermination()
    return comparable(zone_less(rollups.revenue_by_source(spark, f"{root}/summaries")))


def merged(report: Callable[[SparkSession, str], DataFrame], batches: int = 3) -> Query:
    """A report merged from partial tables, which several batches of stored credits brought up to date."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        root = fresh_root(spark, "merged")
        winners = first_clicks(shop.clicks(spark, folder), shop.checkouts(spark, folder), HOUR)
        timed = {c: F.col(c).cast("timestamp") for c in ("checkout_timestamp",)}
        click = F.col("click").withField("event_timestamp", F.col("click.event_timestamp").cast("timestamp"))
        winners = winners.withColumns(timed).withColumn("click", click).select(*WINNER_SCHEMA.names)
        winners.write.parquet(f"{root}/credits")
        winners = spark.read.schema(WINNER_SCHEMA).parquet(f"{root}/credits")
        ensure_table(spark, f"{root}/store", stored_schema(WINNER_SCHEMA))
        update = rollups.summarising_writer(f"{root}/store", f"{root}/summaries", users=shop.users(spark, folder))
        for number in range(batches):
            batch = winners.where(F.pmod(F.xxhash64("checkout_id"), F.lit(batches)) == number)
            write_by_date(batch, str(number), f"{root}/store", "checkout_timestamp")
            update(batch, number)
        return comparable(report(spark, f"{root}/summaries"))

    return query


def _comparable(query: Query) -> Query:
    return lambda spark, folder: comparable(query(spark, folder))


_REPORTS: dict[str, Query] = {
    "raw_clicks": lambda s, f: tables.raw_clicks(shop.clicks(s, f)),
    "raw_checkouts": lambda s, f: tables.raw_checkouts(shop.checkouts(s, f)),
    "dedup_events": lambda s, f: dedup_events(repeated_events(s, f)),
    "attribution_pairs": pairs(HOUR),
    "attribution_pairs_24h": pairs(DAY),
    "clicks_in_window": click_counts(HOUR),
    "clicks_in_window_24h": click_counts(DAY),
    "first_click_attribution": lambda s, f: attributed(s, f),
    "first_click_attribution_24h": lambda s, f: attributed(s, f, DAY),
    "revenue_by_source": on_attributed(reports.revenue_by_source),
    "revenue_by_source_24h": on_attributed(reports.revenue_by_source, DAY),
    "time_to_purchase": on_attributed(reports.time_to_purchase),
    "time_to_purchase_24h": on_attributed(reports.time_to_purchase, DAY),
    "category_performance": on_attributed(reports.category_performance),
    "category_performance_24h": on_attributed(reports.category_performance, DAY),
    "device_conversion": on_attributed(reports.device_conversion),
    "device_conversion_24h": on_attributed(reports.device_conversion, DAY),
    "hourly_revenue": hourly_revenue(24),
    "hourly_revenue_720h": hourly_revenue(720),
    "segment_performance": segment_performance,
    "top_products": on_attributed(reports.top_products),
    "top_products_24h": on_attributed(reports.top_products, DAY),
    "click_to_checkout_rate": click_to_checkout_rate,
    "stored_click_to_checkout_rate": stored_click_to_checkout_rate,
    "stored_pairs_of_a_payment": stored_pairs_of_a_payment,
    "colocated_first_click_attribution": lambda s, f: colocated.first_click_attribution(s, stored_timeline(s, f)),
    "colocated_attribution_pairs": lambda s, f: colocated.attribution_pairs(s, stored_timeline(s, f)),
    "colocated_segment_performance": colocated_segments,
    "clicks_per_checkout": clicks_per_checkout(HOUR),
    "clicks_per_checkout_24h": clicks_per_checkout(DAY),
    "clicks_per_checkout_30d": clicks_per_checkout(MONTH),
    "pipeline_health": pipeline_health(1),
    "mv_revenue_by_source": on_attributed(SUMMARIES["mv_revenue_by_source"]),
    "mv_category_performance": on_attributed(SUMMARIES["mv_category_performance"]),
    "mv_device_analysis": on_attributed(SUMMARIES["mv_device_analysis"]),
    "refresh_summaries": refreshed_summary,
    "sql_revenue_by_source": sql_report("revenue_by_source()"),
    "sql_time_to_purchase": sql_report("time_to_purchase()"),
    "sql_category_performance": sql_report("category_performance()"),
    "sql_device_conversion": sql_report("device_conversion()"),
    "sql_hourly_revenue_720h": sql_report("hourly_revenue(hours => 720, as_of => {clock})"),
    "sql_segment_performance": sql_report("segment_performance()"),
    "sql_top_products": sql_report("top_products()"),
    "sql_click_to_checkout_rate": sql_report("click_to_checkout_rate(as_of => {clock})"),
    "sql_clicks_per_checkout_24h": sql_report("clicks_per_checkout(window_seconds => 86400)"),
    "sql_pipeline_health": sql_report("pipeline_health(as_of => {clock})"),
    "users_dimension": users_dimension,
    "users_by_segment": lambda s, f: reports.users_by_segment(shop.users(s, f)),
    "seed_summary": lambda s, f: reports.seed_summary(shop.users(s, f)),
    "table_stats": lambda s, f: table_stats(stored_tables(s, f)),
    "table_sample": all_table_samples,
    "audit_constraints": audit,
}

QUERIES: dict[str, Query] = {
    "parse_clicks": parse_clicks,
    "parse_checkouts_nested": parse_checkouts_nested,
    "shipped_by_country": shipped_by_country,
    **{name: _comparable(query) for name, query in _REPORTS.items()},
    "streaming_attribution": streamed_attribution(HOUR),
    "streaming_attribution_24h": streamed_attribution(DAY),
    "streaming_raw_clicks": streamed_raw(0, start_raw_clicks, tables.raw_clicks),
    "streaming_raw_checkouts": streamed_raw(1, start_raw_checkouts, tables.raw_checkouts),
    "streaming_pairs": streamed_pairs(final=False),
    "streaming_final_winner": streamed_pairs(final=True),
    "streaming_checkout_outcomes": checkout_outcomes,
    "refresh_summaries_incremental": incremental_summary,
    "category_performance_merged": merged(rollups.category_performance),
    "segment_performance_merged": merged(rollups.segment_performance),
}
