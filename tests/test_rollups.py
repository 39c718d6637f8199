"""Summaries kept up batch by batch, mergeable distinct counts, late events and store upkeep."""

from __future__ import annotations

import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickledger.operators.bitmaps import add_numbers, bitmaps_of, merged_count
from clickledger.plans import reports, rollups
from clickledger.plans.summaries import SUMMARIES
from clickledger.schemas import EVENT_SCHEMA, RAW_CHECKOUT_SCHEMA, WINNER_SCHEMA
from clickledger.sources import shop_events as shop
from clickledger.streaming.attribution import attributing_writer, current_winners, events_of, read_attributed
from clickledger.streaming.late import WatermarkDrops, checkout_outcomes, late_events, read_late
from clickledger.streaming.pipeline import close_days, start_attribution, start_raw_checkouts, start_raw_clicks
from clickledger.streaming.sinks import NO_DAY, compact_days, ensure_table, keyed_writer, read_recent, stored_schema, write_by_date
from compare import spark_rows

SMALL = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}


def credit(checkout, user, at, click, seconds, source="google", category="Books", device="mobile", revenue="5.00"):
    clicked = datetime.fromisoformat(at) - timedelta(seconds=seconds)
    return (checkout, user, at, revenue, clicked.isoformat(sep=" "), click, category, source, device)


@pytest.fixture
def credits(spark):
    def make(*rows):
        df = spark.createDataFrame(list(rows), "checkout_id STRING, user_id STRING, at STRING, amount STRING, clicked STRING, "
                                   "click_id STRING, category STRING, source STRING, device STRING")  # fmt: skip
        click = F.struct(
            F.col("clicked").cast("timestamp").alias("event_timestamp"), F.col("click_id").alias("event_id"),
            F.lit("P").alias("product_id"), F.lit("Product").alias("product_name"), F.col("category").alias("product_category"),
            F.col("source").alias("referrer"), F.col("device").alias("device_type"),
        )
        return df.select(
            "checkout_id", "user_id", F.col("at").cast("timestamp").alias("checkout_timestamp"),
            F.col("amount").cast("decimal(10,2)").alias("revenue"), click.alias("click"),
        )

    return make


@pytest.fixture
def store(spark, tmp_path):
    """Batches of credits go in; the summaries follow."""
    root, summaries = str(tmp_path / "store"), str(tmp_path / "summaries")
    ensure_table(spark, root, stored_schema(WINNER_SCHEMA))
    users = spark.createDataFrame([("u1", "gold"), ("u2", "gold"), ("u3", None)], "user_id STRING, customer_segment STRING")
    update = rollups.summarising_writer(root, summaries, users=users)

    def put(batch, number):
        write_by_date(batch, str(number), root, "checkout_timestamp")
        update(batch, number)

    put.root, put.summaries, put.users = root, summaries, users
    return put


def check_equal(spark, store):
    whole = current_winners(spark, store.root)
    for name, merged in rollups.MERGED.items():
        full = SUMMARIES[name](whole)
        got = merged(spark, store.summaries)
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in full.schema]
        assert spark_rows(got) == spark_rows(full)
    full = reports.segment_performance(whole, store.users)
    assert spark_rows(rollups.segment_performance(spark, store.summaries).select(*full.columns)) == spark_rows(full)


def files_of(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def test_refresh_after_each_batch_equals_the_full_build(spark, store, credits):
    first = credits(
        credit("k1", "u1", "2024-01-01 10:10:00", "c1", 60), credit("k2", "u2", "2024-01-01 10:50:00", "c2", 600, "email"),
        credit("k3", "u1", "2024-01-01 12:00:00", "c3", 5), credit("k4", "u1", "2024-01-02 00:00:00", "c4", 70, None, None, None),
        credit("k9", "u3", "2024-01-03 09:00:00", "c9", 7, revenue=None),
    )
    store(first, 0)
    check_equal(spark, store)
    before = files_of(f"{store.summaries}/cells")
    # k1 moves to an earlier click of another source and category; a new checkout on the second day.
    second = credits(
        credit("k1", "u1", "2024-01-01 10:10:00", "c0", 900, "direct", "Toys", "desktop"),
        credit("k5", "u4", "2024-01-02 05:00:00", "c5", 30), credit("k6", "u2", "2024-01-02 05:30:00", "c6", 30),
    )
    store(second, 1)
    check_equal(spark, store)
    after = files_of(f"{store.summaries}/cells")
    rewritten = {os.path.dirname(f) for f in set(before) ^ set(after)}
    assert rewritten == {"event_date=2024-01-01/event_hour=10", "event_date=2024-01-02/event_hour=5"}
    store(second, 1)  # a replay
    check_equal(spark, store)
    store(credits(), 2)
    check_equal(spark, store)


def test_refresh_reads_only_the_days_touched(spark, store, credits, monkeypatch):
    store(credits(*[credit(f"k{d}", "u1", f"2024-02-{d:02d} 08:00:00", "c", 9) for d in range(1, 21)]), 0)
    asked = []

    def noting(spark, root, days=None):
        winners = current_winners(spark, root, days)
        asked.append(sorted({f.split("event_date=")[1][:10] for f in winners.inputFiles()}))
        return winners

    monkeypatch.setattr(rollups, "current_winners", noting)
    store(credits(credit("k99", "u2", "2024-02-05 23:00:00", "c", 9)), 1)
    assert asked == [["2024-02-05"]]


def test_distinct_counts_merge_exactly(spark, tmp_path):
    rows = spark.range(120_000).selectExpr("concat('u', id % 70000) AS user_id", "CAST(id % 3 AS INT) AS day", "id % 7 AS kind")
    root = str(tmp_path / "numbers")
    first = add_numbers(spark, root, rows.where("day = 0").repartition(5), "0")
    assert first.agg(F.max("number"), F.count_distinct("number")).first()[:] == (first.count(), first.count())
    once = {(r.user_id, r.number) for r in add_numbers(spark, root, rows, "1").collect()}
    numbers = add_numbers(spark, root, rows, "1")
    again = {(r.user_id, r.number) for r in numbers.collect()}
    assert again == once and len(again) == 70_000
    assert sorted(n for _, n in again) == list(range(1, 70_001))
    bitmaps = bitmaps_of(rows.join(numbers, "user_id"), "day", "kind")
    assert spark_rows(merged_count(bitmaps, "n", "kind")) == spark_rows(rows.groupBy("kind").agg(F.count_distinct("user_id").alias("n")))
    assert merged_count(bitmaps, "n").first().n == 70_000


def test_deliveries_move_the_watermark_and_late_events_are_kept(spark, tmp_path):
    tables, checkpoint = str(tmp_path / "tables"), str(tmp_path / "checkpoint")
    shop.deliver(spark, SMALL, str(tmp_path / "feed"))
    events = shop.delivered_stream(spark, str(tmp_path / "feed"))
    clicks, checkouts = shop.shape_clicks(events), shop.shape_checkouts(events)
    drops = WatermarkDrops()
    spark.streams.addListener(drops)
    try:
        attribution = start_attribution(
            clicks, checkouts, f"{tables}/attributed_checkouts", checkpoint, delay=shop.DELAY, trigger=ONCE
        )
        raw = [
            start_raw_clicks(clicks, f"{tables}/raw_clicks", checkpoint, ONCE),
            start_raw_checkouts(checkouts, f"{tables}/raw_checkouts", checkpoint, ONCE),
        ]
        for query in (attribution, *raw):
            query.awaitTermination()
    finally:
        spark.streams.removeListener(drops)
    progress = [p for p in attribution.recentProgress if p["numInputRows"]]
    assert len(progress) >= shop.DROPS
    marks = [p["eventTime"].get("watermark") for p in progress]
    assert len(set(marks)) >= shop.DROPS - 1 and marks == sorted(marks)
    delivered = shop.deliveries(spark, SMALL)
    late = delivered.where("event_id % 50 = 7 AND drop >= 3 AND event_type IN ('click', 'purchase')")
    first, last = spark.read.parquet(f"{SMALL}/events.parquet").agg(F.min("ts"), F.max("ts")).first()
    cut = first + (last - first) * 5 / 8
    expected = {str(r.event_id) for r in late.where(F.col("ts") < F.lit(cut)).select("event_id").distinct().collect()}
    found = {feed: {r.event_id for r in late_events(spark, tables, feed).collect()} for feed in ("clicks", "checkouts")}
    assert found["clicks"] | found["checkouts"] == expected and found["clicks"] and found["checkouts"]
    assert drops.rows["attribution"] >= len(expected)

    outcomes = spark_rows(checkout_outcomes(spark, tables))
    winners = spark_rows(read_attributed(spark, f"{tables}/attributed_checkouts").drop("processed_at"))
    days = [str(r.d) for r in spark.read.parquet(f"{SMALL}/events.parquet").select(F.to_date("ts").alias("d")).distinct().collect()]
    close_days(spark, tables, days)
    assert {r.event_id for f in found for r in read_late(spark, tables, f).collect()} == expected
    assert spark_rows(checkout_outcomes(spark, tables)) == outcomes
    assert spark_rows(read_attributed(spark, f"{tables}/attributed_checkouts").drop("processed_at")) == winners
    for table in ("attributed_checkouts", "attributed_checkouts_events", "raw_clicks", "raw_checkouts"):
        for day in Path(tables, table).glob("event_date=*"):
            assert len(list(day.glob("batch_id=*"))) == 1, table  # one folder a day, whatever the history
    close_days(spark, tables, [], expired=days)
    assert not list(Path(tables, "attributed_checkouts_events").glob("event_date=*"))
    assert spark_rows(read_attributed(spark, f"{tables}/attributed_checkouts", f"{tables}/attributed_settled").drop("processed_at")) == winners


def test_attribution_lists_the_days_in_reach_only(spark, tmp_path, monkeypatch):
    from clickledger.streaming import attribution

    root, asked = str(tmp_path / "table"), []
    for folder, schema in ((root, WINNER_SCHEMA), (events_of(root), EVENT_SCHEMA)):
        ensure_table(spark, folder, stored_schema(schema))
    real = attribution.read_store

    def noting(spark, root, schema, days=None):
        asked.append([str(d) for d in days])
        return real(spark, root, schema, days)

    monkeypatch.setattr(attribution, "read_store", noting)
    write = attributing_writer(root)
    for number, day in enumerate(("2024-01-01", "2024-01-09", "2024-01-20")):
        row = spark.createDataFrame([(f"u{number}",)], "user_id STRING").select(
            "user_id", F.lit(f"{day} 00:30:00").cast("timestamp").alias("event_timestamp"),
            F.lit(None).cast(EVENT_SCHEMA["click"].dataType).alias("click"), F.lit(None).cast(EVENT_SCHEMA["checkout"].dataType).alias("checkout"),
        )
        write(row, number)
    assert asked == [["2023-12-31", "2024-01-01"], ["2024-01-08", "2024-01-09"], ["2024-01-19", "2024-01-20"]]


def test_recent_rows_are_each_event_once(spark, make_checkouts, tmp_path):
    root = str(tmp_path / "raw")
    ensure_table(spark, root, stored_schema(RAW_CHECKOUT_SCHEMA))
    write = keyed_writer(root, RAW_CHECKOUT_SCHEMA, "event_id", "event_timestamp")
    write(make_checkouts(("k", "u", "2024-01-02 10:00:00", "5"), ("m", "u", "2024-01-02 08:00:00", "5")), 0)
    write(make_checkouts(("k", "u", "2024-01-02 10:05:00", "5"), ("m", "u", "2024-01-02 11:00:00", "5")), 1)
    since = F.lit("2024-01-02 09:00:00").cast("timestamp")
    recent = read_recent(spark, root, RAW_CHECKOUT_SCHEMA, "event_id", "event_timestamp", since)
    assert [(r.event_id, str(r.event_timestamp)) for r in recent.collect()] == [("k", "2024-01-02 10:00:00")]


def test_rows_without_a_day_are_compacted_too(spark, tmp_path):
    root = str(tmp_path / "raw")
    rows = spark.createDataFrame([("a",), ("b",)], "event_id STRING").withColumn("event_timestamp", F.lit(None).cast("timestamp"))
    schema = rows.schema
    for number in range(2):
        write_by_date(rows, str(number), root, "event_timestamp")
    compact_days(spark, root, schema, [None], "event_timestamp", lambda stored: stored.dropDuplicates(["event_id"]))
    assert len(list(Path(root, f"event_date={NO_DAY}").glob("batch_id=*"))) == 1
    assert sorted(r.event_id for r in spark.read.parquet(root).collect()) == ["a", "b"]
