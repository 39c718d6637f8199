"""Report edge cases, summaries and their refresh, users, table rules."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickledger.operators.first_click import first_click_attribution
from clickledger.plans import reports
from clickledger.plans.quality import audit_table
from clickledger.plans.stats import table_sample, table_stats
from clickledger.plans.summaries import SUMMARIES, read_summary, refresh_all
from clickledger.sources.versioned import drop_old_versions
from clickledger.queries import attributed
from clickledger.schemas import RULES, TableRules
from clickledger.sources import shop_events as shop
from clickledger.sources import tables
from conftest import SMALL

NOON = datetime(2024, 1, 1, 12)


@pytest.fixture
def small(make_clicks, make_checkouts):
    clicks = make_clicks(("c1", "u", "2024-01-01 09:00:00"), ("c2", "v", "2024-01-01 09:59:59"))
    checkouts = make_checkouts(
        ("k1", "u", "2024-01-01 10:00:00", "10.00"), ("k2", "v", "2024-01-01 10:00:00", "5.35")
    )
    return clicks, checkouts, first_click_attribution(clicks, checkouts)


def test_a_full_hour_counts_as_more_than_an_hour(small):
    rows = reports.time_to_purchase(small[2]).collect()
    assert [(r.time_bucket, r.conversion_count) for r in rows] == [
        ("< 5 minutes", 1),
        ("> 1 hour", 1),
    ]


def test_no_clicks_gives_no_rate_and_no_error(small):
    clicks, checkouts, _ = small
    row = reports.click_to_checkout_rate(clicks, checkouts, as_of=NOON).first()
    assert (row.total_clicks, row.total_checkouts, row.conversion_rate) == (0, 0, None)
    row = reports.click_to_checkout_rate(clicks, checkouts, hours=24, as_of=NOON).first()
    assert (row.total_clicks, row.total_checkouts, float(row.conversion_rate)) == (2, 2, 100.0)


def test_health_without_recent_rows(small):
    rows = {r.metric: r.value for r in reports.pipeline_health(*small, as_of=NOON).collect()}
    assert rows == {
        "Clicks (Last Hour)": 0.0,
        "Checkouts (Last Hour)": 0.0,
        "Attributed Checkouts (Last Hour)": 0.0,
        "Total Revenue (Last Hour)": 0.0,
    }


def test_recent_reports_follow_the_clock_by_default(small):
    assert reports.hourly_revenue(small[2]).count() == 0
    assert reports.hourly_revenue(small[2], hours=24, as_of=NOON).first().hour == datetime(2024, 1, 1, 10)


def test_averages_round_half_up_in_decimal(make_clicks, make_checkouts):
    clicks = make_clicks(("c", "u", "2024-01-01 10:00:00"))
    checkouts = make_checkouts(
        ("k1", "u", "2024-01-01 10:00:01", "2.67"), ("k2", "u", "2024-01-01 10:00:02", "2.68")
    )
    table = first_click_attribution(clicks, checkouts)
    assert str(reports.time_to_purchase(table).first().avg_revenue) == "2.68"


def test_shares_add_up(spark):
    rows = reports.revenue_by_source(attributed(spark, SMALL)).collect()
    assert abs(sum(float(r.revenue_percentage) for r in rows) - 100) <= 0.05


def test_empty_attribution_gives_empty_reports(make_clicks, make_checkouts):
    clicks = make_clicks(("c", "u", "2024-01-01 10:00:00"))
    checkouts = make_checkouts(("k", "w", "2024-01-01 10:00:01", "1"))
    table = first_click_attribution(clicks, checkouts)
    assert reports.revenue_by_source(table).count() == 0
    assert reports.clicks_per_checkout(clicks, checkouts).count() == 0


def test_refresh_keeps_the_old_version_for_its_readers(spark, small, tmp_path):
    root = str(tmp_path / "mv")
    refresh_all(small[2], root)
    before = read_summary(spark, root, "mv_device_analysis")
    refresh_all(small[2].where("checkout_id = 'k1'"), root)
    after = read_summary(spark, root, "mv_device_analysis")
    assert before.first().conversion_count == 2
    assert after.first().conversion_count == 1
    assert {name: read_summary(spark, root, name).count() for name in SUMMARIES} == {
        "mv_revenue_by_source": 1,
        "mv_category_performance": 1,
        "mv_device_analysis": 1,
    }


def test_a_failed_refresh_shows_nothing_and_old_versions_go(spark, small, tmp_path, monkeypatch):
    root = str(tmp_path / "mv")
    first = refresh_all(small[2], root)
    old = {name: sorted(read_summary(spark, root, name).collect()) for name in SUMMARIES}

    def broken(attributed):
        raise RuntimeError("no device")

    monkeypatch.setitem(SUMMARIES, "mv_device_analysis", broken)
    with pytest.raises(RuntimeError, match="no device"):
        refresh_all(small[2].where("checkout_id = 'k1'"), root)
    assert {name: sorted(read_summary(spark, root, name).collect()) for name in SUMMARIES} == old
    monkeypatch.undo()
    assert drop_old_versions(spark, root, timedelta(0)) == []
    refresh_all(small[2], root)
    assert drop_old_versions(spark, root, timedelta(hours=1)) == []
    assert drop_old_versions(spark, root, timedelta(0)) == [first]
    assert {name: sorted(read_summary(spark, root, name).collect()) for name in SUMMARIES} == old


def test_users_get_defaults(spark):
    row = ("U1", "a@x.org", "A", "B", datetime(2024, 1, 1), "new", None)
    user = tables.users_from_rows(spark, [row]).first()
    assert str(user.lifetime_value) == "0.00"
    assert user.created_at is not None and user.updated_at is not None


def test_users_by_rule(spark):
    numbers = spark.range(16, 19).select(
        F.col("id").alias("i"),
        F.lit(30).alias("days_registered"),
        F.lit(12.345).alias("lifetime_value"),
    )
    users = tables.users_dimension(numbers, date(2024, 1, 31)).orderBy("user_id").collect()
    assert [u.user_id for u in users] == ["USER-00016", "USER-00017", "USER-00018"]
    assert [u.customer_segment for u in users] == ["regular", "new", "premium"]
    assert users[0].email == "user16@email.com" and users[0].registration_date == date(2024, 1, 1)


def test_long_user_numbers_stay_apart(spark):
    numbers = [10000, 100000, 1000000, 10**9, 10**10]
    rows = spark.createDataFrame([(n, 1, 1.0) for n in numbers], "i LONG, days_registered INT, lifetime_value DOUBLE")
    assert len({u.user_id for u in tables.users_dimension(rows, date(2024, 1, 31)).collect()}) == 5
    keys = rows.selectExpr(f"{shop.user_key('i')} AS user_id").collect()
    assert keys[0].user_id == "USER-000010000" and keys[-1].user_id == "USER-10000000000"


def test_audit_counts_violations(spark):
    rules = TableRules(("id",), ("id", "name", "absent"), {"name": 3}, ("amount",))
    table = spark.createDataFrame(
        [("a", "long name", 1.0), ("a", None, 1e9), ("a", "ok", 1.0), (None, "ok", None)],
        "id STRING, name STRING, amount DOUBLE",
    )
    found = {(r.rule, r.column_name): r.violations for r in audit_table("t", table, rules).collect()}
    assert found == {
        ("UNIQUE", "id"): 1,
        ("NOT NULL", "id"): 1,
        ("NOT NULL", "name"): 1,
        ("NOT NULL", "absent"): 4,
        ("MAX LENGTH", "name"): 1,
        ("MONEY RANGE", "amount"): 1,
    }


def test_audit_without_its_key_and_of_no_rows(spark):
    table = spark.range(3).withColumnRenamed("id", "other")
    found = audit_table("t", table, TableRules(("id",), ("id",))).collect()
    assert [(r.rule, r.violations) for r in found] == [("UNIQUE", 3), ("NOT NULL", 3)]
    found = audit_table("t", table.limit(0), TableRules(("other",), ("other",))).collect()
    assert [(r.rule, r.violations) for r in found] == [("UNIQUE", 0), ("NOT NULL", 0)]


def test_audit_of_a_good_table(small):
    table = tables.with_load_time(small[2], "processed_at")
    rows = audit_table("attributed_checkouts", table, RULES["attributed_checkouts"]).collect()
    assert len(rows) == 18 and not any(r.violations for r in rows)


def test_stats_and_samples(spark):
    table = spark.range(20).withColumnRenamed("id", "n")
    assert [tuple(r) for r in table_stats({"t": table}).collect()] == [("t", 20)]
    assert [r.n for r in table_sample(table, "n").collect()] == [0, 1, 2, 3, 4]


def test_tables_can_be_named_for_sql(spark, small):
    clicks, checkouts, winners = small
    tables.register_views(
        raw_clicks=tables.raw_clicks(clicks),
        raw_checkouts=tables.raw_checkouts(checkouts),
        attributed_checkouts=winners,
    )
    in_sql = spark.sql(
        "SELECT device_type, COUNT(*) AS n, SUM(revenue) AS total_revenue "
        "FROM attributed_checkouts GROUP BY device_type"
    ).first()
    report = reports.device_conversion(winners).first()
    assert (in_sql.n, in_sql.total_revenue) == (report.conversions, report.total_revenue)
