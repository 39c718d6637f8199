"""Plans: what reaches the scans, and what must not appear anywhere."""

from __future__ import annotations

import re
from datetime import timedelta

import pytest

import compare
from pyspark.sql import functions as F
from clickledger.operators.first_click import first_click_attribution
from clickledger.queries import QUERIES
from clickledger.streaming.sinks import read_recent
from clickledger.session import shared_dir
from clickledger.sources import shop_events as shop
from conftest import SMALL

BATCH = [name for name in QUERIES if not name.startswith(("streaming", "refresh", "audit"))]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_window_over_everything(spark, name):
    plan = compare.plan_text(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    if "Window" in plan:
        assert "hashpartitioning(user_id" in plan or "Bucketed: true" in plan


def test_filters_and_columns_reach_the_scans(spark):
    plan = compare.plan_text(QUERIES["first_click_attribution"](spark, SMALL))
    assert "EqualTo(event_type,click)" in plan and "EqualTo(event_type,purchase)" in plan
    reads = re.findall(r"ReadSchema: (.*)", plan)
    assert len(reads) == 2
    click_side, checkout_side = sorted(reads, key=lambda r: "props" not in r)
    assert "value" not in click_side and "props" not in checkout_side


def test_recent_reports_prune_both_scans_by_time(spark):
    plan = compare.plan_text(QUERIES["hourly_revenue"](spark, SMALL))
    times = [f for f in re.findall(r"Condition : (.*)", plan) if "event_type" in f and ">=" in f]
    assert len(times) >= 2


def test_recent_reads_of_a_stored_table_prune_days(spark, tmp_path):
    hours = spark.range(40 * 24).selectExpr("id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS at")
    stored = hours.withColumns({"event_date": F.to_date("at"), "batch_id": F.lit("0"), "created_at": F.current_timestamp()})
    root = str(tmp_path / "stored")
    stored.repartitionByRange(80, "at").write.partitionBy("event_date", "batch_id").parquet(root)
    since = spark.read.parquet(root).agg(F.max("at") - F.lit(timedelta(hours=24))).scalar()
    recent = read_recent(spark, root, hours.schema, "id", "at", since)
    assert recent.count() == 25
    plan = compare.plan_text(recent)
    assert re.search(r"PartitionFilters: .*event_date.*>=", plan)


def test_attribution_shuffles_each_feed_once_by_user(spark):
    plan = compare.plan_text(QUERIES["first_click_attribution"](spark, SMALL))
    tree = plan.split("(1) Scan")[0]
    assert tree.count("Exchange") == 2 and "Join" not in tree


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
