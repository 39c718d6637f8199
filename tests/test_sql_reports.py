"""The reports as SQL table functions; their results are compared with other SQL in test_oracle."""

from __future__ import annotations

from datetime import timedelta

from clickledger.operators.first_click import first_click_attribution
from clickledger.plans.sql_reports import REPORTS, register_reports
from clickledger.sources import shop_events as shop
from clickledger.sources.tables import register_views
from compare import plan_text, spark_rows

SMALL = "/root/testdata/sf0.001"


def register(spark):
    clicks, checkouts = shop.clicks(spark, SMALL), shop.checkouts(spark, SMALL)
    attributed = first_click_attribution(clicks, checkouts, timedelta(hours=24))
    register_views(raw_clicks=clicks, raw_checkouts=checkouts, attributed_checkouts=attributed, users=shop.users(spark, SMALL))
    register_reports(spark)
    return attributed


def test_first_clicks_in_sql_are_those_of_the_operator(spark):
    attributed = register(spark)
    got = spark.sql("SELECT * FROM first_clicks_in(window_seconds => 86400)")
    assert spark_rows(got) == spark_rows(attributed.select(*got.columns)) and got.count() > 20


def test_functions_take_defaults_and_join_with_tables(spark):
    register(spark)
    for name in REPORTS:
        spark.sql(f"SELECT * FROM {name}()").collect()
    top = spark.sql("SELECT traffic_source FROM revenue_by_source() WHERE traffic_source = 'email'")
    assert [r.traffic_source for r in top.collect()] == ["email"]


def test_a_caller_s_filter_and_columns_reach_the_scan(spark):
    register(spark)
    spark.read.parquet(f"{SMALL}/events.parquet").createOrReplaceTempView("events")
    rate = spark.sql("SELECT total_clicks FROM click_to_checkout_rate(as_of => (SELECT max(ts) FROM events))")
    assert "props" not in plan_text(rate)
