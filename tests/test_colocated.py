"""Bucketed tables, pruning while a query runs, and records kept whole."""

from __future__ import annotations

import json
import re
import uuid
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import compare
from clickledger.operators import interval_join
from clickledger.operators.first_click import first_click_attribution
from clickledger.queries import stored_pairs_of_a_payment
from clickledger.schemas import CHECKOUT_SCHEMA
from clickledger.sources import colocated, feeds
from clickledger.sources import shop_events as shop
from conftest import SMALL

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture
def timeline(spark, tmp_path):
    def write(clicks, checkouts, reach=timedelta(hours=1), buckets=4):
        name = f"timeline_{uuid.uuid4().hex}"
        colocated.write_timeline(clicks, checkouts, name, str(tmp_path / name), buckets, reach)
        return name

    return write


def shuffles(df) -> list[str]:
    return re.findall(r"hashpartitioning\(([^)]*)\)", compare.plan_text(df))


def test_attribution_and_pairs_need_no_shuffle(spark, timeline, no_broadcast):
    name = timeline(shop.clicks(spark, SMALL), shop.checkouts(spark, SMALL))
    credits, pairs = colocated.first_click_attribution(spark, name), colocated.attribution_pairs(spark, name)
    for df in (credits, pairs):
        plan = compare.plan_text(df)
        assert "Exchange" not in plan and "Bucketed: true" in plan and "BroadcastHashJoin" not in plan


def test_segments_shuffle_one_row_a_user(spark, timeline, tmp_path, no_broadcast):
    colocated.write_users(shop.users(spark, SMALL), "users_here", str(tmp_path / "users"), 4)
    credits = colocated.first_click_attribution(spark, timeline(shop.clicks(spark, SMALL), shop.checkouts(spark, SMALL)))
    plan = compare.plan_text(colocated.segment_performance(credits, spark.table("users_here")))
    tree = plan.split("\n\n")[0]
    # The only shuffle by user is that of the sums, after their map-side half.
    assert shuffles(colocated.segment_performance(credits, spark.table("users_here")))[0].startswith("user_id")
    assert tree.count("Bucketed") == 0 and plan.count("Bucketed: true") == 2
    assert sum("user_id" in s for s in re.findall(r"hashpartitioning\(([^)]*)\)", plan)) == 1


@pytest.mark.parametrize("hours", [1, 24, 24 * 30])
def test_equals_the_other_operators_for_windows_within_the_reach(spark, timeline, hours):
    reach = timedelta(hours=hours)
    clicks, checkouts = shop.clicks(spark, MEDIUM), shop.checkouts(spark, MEDIUM)
    name = timeline(clicks, checkouts, reach, buckets=8)
    for window in (reach, reach / 2):
        want = compare.spark_rows(first_click_attribution(clicks, checkouts, window))
        assert compare.spark_rows(colocated.first_click_attribution(spark, name, window)) == want
    want = compare.spark_rows(interval_join.attribution_pairs(clicks, checkouts, reach))
    assert compare.spark_rows(colocated.attribution_pairs(spark, name, reach)) == want


def test_copies_ties_and_rows_that_match_nothing(spark, timeline, make_clicks, make_checkouts):
    clicks = make_clicks(
        ("c2", "u", "2024-01-01 07:59:59"), ("c1", "u", "2024-01-01 07:59:59"), ("c1", "u", "2024-01-01 07:59:59"),
        ("c3", "u", "2024-01-01 09:00:00"), ("c4", None, "2024-01-01 08:30:00"), ("c5", "u", None),
    )
    checkouts = make_checkouts(
        ("o1", "u", "2024-01-01 08:30:00", "1"), ("o1", "u", "2024-01-01 08:30:00", "1"), ("o2", "u", "2024-01-01 09:00:00", "2"),
        ("o3", "v", "2024-01-01 09:00:00", "3"), ("o4", None, "2024-01-01 08:30:00", "4"), ("o5", "u", None, "5"),
    )
    name = timeline(clicks, checkouts)
    got = {(r.checkout_id, r.attributed_click_id) for r in colocated.first_click_attribution(spark, name).collect()}
    assert got == {("o1", "c1"), ("o2", "c3")}
    assert colocated.attribution_pairs(spark, name).count() == 3
    assert colocated.first_click_attribution(spark, timeline(clicks.limit(0), checkouts)).count() == 0
    with pytest.raises(ValueError, match="reaches back"):
        colocated.first_click_attribution(spark, name, timedelta(hours=2))


def test_a_busy_user_is_in_many_buckets(spark, timeline, tmp_path):
    hours = spark.range(24 * 60).selectExpr(
        "CAST(id AS STRING) AS event_id", "'u' AS user_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS event_timestamp",
        "'p' AS product_id", "'p' AS product_name", "'c' AS product_category", "'r' AS referrer", "'d' AS device_type", "CAST(1 AS DECIMAL(10,2)) AS total_amount",
    )
    name = timeline(hours, hours.limit(0), buckets=16)
    sizes = [r["count"] for r in spark.table(name).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * sum(sizes) / 16


# --- pruning ------------------------------------------------------------------------------------


def scanned(df) -> int:
    """Rows that the scans gave, once ``df`` has run."""
    df.collect()
    leaves, rows = df._jdf.queryExecution().executedPlan().collectLeaves(), 0
    for i in range(leaves.size()):
        metric = leaves.apply(i).metrics().get("numOutputRows")
        rows += metric.get().value() if metric.isDefined() else 0
    return rows


@pytest.fixture
def stored(spark, tmp_path):
    """40 days of hourly clicks of 50 users with day folders, and a checkout of two users each day."""
    rows = spark.range(40 * 24 * 50).selectExpr(
        "CAST(id AS STRING) AS event_id", "CONCAT('u', id % 50) AS user_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, CAST(id DIV 50 AS INT)) AS event_timestamp"
    ).withColumn("event_date", F.to_date("event_timestamp"))
    rows.repartition("event_date").write.partitionBy("event_date").parquet(str(tmp_path / "clicks"))
    days = spark.range(80).selectExpr(
        "CONCAT('o', id) AS event_id", "CONCAT('u', id % 2) AS user_id", "timestamp'2024-01-01 00:20:00' + make_interval(0, 0, 0, CAST(id DIV 2 AS INT)) AS event_timestamp",
        "CAST(1 AS DECIMAL(10,2)) AS total_amount", "IF(id DIV 2 = 20, 'paypal', 'card') AS payment_method",
    )
    days.write.parquet(str(tmp_path / "checkouts"))
    return spark.read.parquet(str(tmp_path / "clicks")), spark.read.parquet(str(tmp_path / "checkouts"))


@pytest.mark.parametrize("window", [timedelta(hours=5), timedelta(hours=1), timedelta(days=3)])
def test_days_of_the_checkouts_prune_the_clicks(spark, stored, window):
    clicks, checkouts = stored
    clicks, some = clicks.where("event_id IS NOT NULL"), checkouts.where("payment_method = 'paypal'")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan that ran is the plan at hand
    try:
        pruned = interval_join.attribution_pairs(clicks, some, window, day="event_date")
        plan = compare.plan_text(pruned)
        assert re.search(r"PartitionFilters: .*dynamicpruning", plan)
        days = 2 + window.days
        assert scanned(pruned) <= days * 24 * 50 + 80
        every = [c for c in pruned.columns]
        want = interval_join.attribution_pairs(clicks, some, window).select(*every)
        assert compare.spark_rows(pruned) == compare.spark_rows(want) and pruned.count() > 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_registered_query_prunes(spark):
    assert re.search(r"PartitionFilters: .*dynamicpruning", compare.plan_text(stored_pairs_of_a_payment(spark, SMALL)))


# --- records kept whole -------------------------------------------------------------------------


def test_fields_outside_the_schema_are_kept(spark, tmp_path):
    texts = [
        {"event_id": "1", "shipping_address": {"country": "US", "lines": ["a", "b"]}, "gift": True},
        {"event_id": "2", "shipping_address": "none"},
        {"event_id": "3"},
    ]
    feed = spark.createDataFrame([(json.dumps(t).encode(),) for t in texts] + [(b"no json",), (None,)], "data binary")
    decoded = feeds.decode(feed, CHECKOUT_SCHEMA, keep="payload")
    assert feeds.decode(feed, CHECKOUT_SCHEMA).columns == [c for c in decoded.columns if c != "payload"]
    decoded.select("event_id", "payload").write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    rows = kept.select(
        "event_id",
        feeds.open_field("$.shipping_address.country", "string").alias("country"),
        feeds.open_field("$.shipping_address.lines[1]", "string").alias("line"),
        feeds.open_field("$.gift", "boolean").alias("gift"),
        feeds.open_field("$.gift", "date").alias("other"),
    ).collect()
    want = [("1", "US", "b", True, None), ("2", None, None, None, None), ("3", None, None, None, None)]
    assert sorted(map(tuple, rows), key=str) == sorted(want + [(None,) * 5] * 2, key=str)
