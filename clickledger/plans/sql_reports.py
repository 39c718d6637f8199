"""The reports as SQL table functions, to be called by name from ``spark.sql``.

    register_views(raw_clicks=…, raw_checkouts=…, attributed_checkouts=…, users=…)
    register_reports(spark)
    spark.sql("SELECT * FROM hourly_revenue(hours => 720, as_of => TIMESTAMP_NTZ'2024-01-31')")

Each function is a parameterised view: Spark puts its body in the caller's plan, so filters and columns
reach the scans as they do for the reports of :mod:`clickledger.plans.reports`, whose results these equal.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from clickledger.functions.buckets import CLICK_COUNT, PURCHASE_DELAY

_CLOCK = "hours DOUBLE DEFAULT {hours}, as_of TIMESTAMP_NTZ DEFAULT NULL"
_WINDOW = "window_seconds BIGINT DEFAULT 3600"


def _recent(time: str) -> str:
    since = "coalesce(as_of, CAST(current_timestamp() AS TIMESTAMP_NTZ)) - hours * INTERVAL 1 HOUR"
    return f"{time} >= {since}"


def _mean(column: str) -> str:
    return f"round(CAST(sum({column}) AS DOUBLE) / count({column}), 6)"


def _ratio(numerator: str, denominator: str) -> str:
    return f"round({numerator} / nullif(CAST({denominator} AS DECIMAL(20,0)), CAST(0 AS DECIMAL(20,0))), 2)"


def _whole(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(20,0))"


def _labels(table: list[tuple]) -> str:
    listed = ", ".join("'" + row[-1].replace("'", "''") + "'" for row in table)
    return f"element_at(array({listed}), bucket_rank)"


_DELAY_RANK = "CASE {} ELSE {} END".format(
    " ".join(f"WHEN attribution_window_seconds < {bound} THEN {i}" for i, (bound, _) in enumerate(PURCHASE_DELAY, 1) if bound is not None),
    len(PURCHASE_DELAY),
)
_COUNT_RANK = "CASE {} ELSE {} END".format(
    " ".join(f"WHEN clicks BETWEEN {low} AND {high} THEN {i}" for i, (low, high, _) in enumerate(CLICK_COUNT, 1) if low is not None),
    len(CLICK_COUNT),
)

# A click and a checkout meet by user and time slot; a slot is as wide as the window, so a checkout is in two.
_PAIRS = """SELECT k.event_id AS checkout_id, k.user_id, k.at AS checkout_timestamp, k.total_amount, c.click
  FROM (SELECT event_id, user_id, event_timestamp AS at, total_amount,
               explode(sequence(floor(unix_timestamp(event_timestamp) / window_seconds) - 1,
                                floor(unix_timestamp(event_timestamp) / window_seconds))) AS slot
        FROM raw_checkouts) AS k
  JOIN (SELECT user_id, floor(unix_timestamp(event_timestamp) / window_seconds) AS slot, event_timestamp AS at,
               struct(event_timestamp AS at, event_id, product_id, product_category, referrer, device_type) AS click
        FROM raw_clicks) AS c
    ON k.user_id = c.user_id AND k.slot = c.slot
   AND c.at <= k.at AND c.at >= k.at - window_seconds * INTERVAL 1 SECOND"""

#: Name to (parameters, body).
REPORTS: dict[str, tuple[str, str]] = {
    "first_clicks_in": (
        _WINDOW,
        f"""SELECT checkout_id, user_id, checkout_timestamp, click.event_id AS attributed_click_id,
  click.product_id AS attributed_product_id, click.product_category AS attributed_category,
  click.referrer AS traffic_source, click.device_type, click.at AS first_click_timestamp, total_amount AS revenue,
  unix_timestamp(checkout_timestamp) - unix_timestamp(click.at) AS attribution_window_seconds
FROM (SELECT checkout_id, user_id, checkout_timestamp, total_amount, min(click) AS click
      FROM ({_PAIRS}) GROUP BY checkout_id, user_id, checkout_timestamp, total_amount)""",
    ),
    "revenue_by_source": (
        "",
        f"""SELECT traffic_source, total_conversions, total_revenue, avg_order_value,
  round(total_revenue * 100 / nullif((SELECT sum(revenue) FROM attributed_checkouts), 0), 2) AS revenue_percentage
FROM (SELECT traffic_source, count(*) AS total_conversions, sum(revenue) AS total_revenue,
        {_mean("revenue")} AS avg_order_value
      FROM attributed_checkouts GROUP BY traffic_source)
ORDER BY total_revenue DESC NULLS FIRST""",
    ),
    "time_to_purchase": (
        "",
        f"""SELECT {_labels(PURCHASE_DELAY)} AS time_bucket, conversion_count, avg_revenue
FROM (SELECT {_DELAY_RANK} AS bucket_rank, count(*) AS conversion_count,
        {_ratio("sum(revenue)", "count(revenue)")} AS avg_revenue
      FROM attributed_checkouts GROUP BY {_DELAY_RANK})
ORDER BY bucket_rank""",
    ),
    "category_performance": (
        "",
        f"""SELECT attributed_category, count(*) AS conversion_count, sum(revenue) AS total_revenue,
  {_mean("revenue")} AS avg_order_value, count(DISTINCT user_id) AS unique_customers
FROM attributed_checkouts GROUP BY attributed_category
ORDER BY total_revenue DESC NULLS FIRST, attributed_category LIMIT 10""",
    ),
    "device_conversion": (
        "",
        f"""SELECT device_type, count(*) AS conversions, round(sum(revenue), 2) AS total_revenue,
  {_ratio("sum(revenue)", "count(revenue)")} AS avg_order_value,
  {_ratio(_whole("sum(attribution_window_seconds)"), "count(attribution_window_seconds) * 60")} AS avg_minutes_to_purchase
FROM attributed_checkouts GROUP BY device_type
ORDER BY total_revenue DESC NULLS FIRST""",
    ),
    "hourly_revenue": (
        _CLOCK.format(hours=24),
        f"""SELECT date_trunc('hour', checkout_timestamp) AS hour, count(*) AS conversions,
  sum(revenue) AS hourly_revenue, {_mean("revenue")} AS avg_order_value
FROM attributed_checkouts WHERE {_recent("checkout_timestamp")}
GROUP BY date_trunc('hour', checkout_timestamp) ORDER BY hour DESC""",
    ),
    "segment_performance": (
        "",
        f"""SELECT customer_segment, count(DISTINCT checkout_id) AS total_orders, count(DISTINCT user_id) AS active_customers,
  sum(revenue) AS total_revenue, {_mean("revenue")} AS avg_order_value,
  round(CAST(sum(revenue) AS DOUBLE) / nullif(count(DISTINCT user_id), 0), 6) AS revenue_per_customer
FROM attributed_checkouts JOIN users USING (user_id) GROUP BY customer_segment
ORDER BY total_revenue DESC NULLS FIRST""",
    ),
    "top_products": (
        "",
        """SELECT attributed_product_id, attributed_product_name, attributed_category, count(*) AS conversion_count,
  sum(revenue) AS total_attributed_revenue
FROM attributed_checkouts GROUP BY attributed_product_id, attributed_product_name, attributed_category
ORDER BY conversion_count DESC, total_attributed_revenue DESC NULLS FIRST,
  attributed_product_id, attributed_product_name, attributed_category LIMIT 20""",
    ),
    "click_to_checkout_rate": (
        _CLOCK.format(hours=1),
        f"""SELECT total_clicks, total_checkouts,
  {_ratio(_whole("total_checkouts * 100"), "total_clicks")} AS conversion_rate
FROM (SELECT count_if(is_click) AS total_clicks, count_if(NOT is_click) AS total_checkouts
      FROM (SELECT event_id, true AS is_click FROM raw_clicks WHERE {_recent("event_timestamp")} AND event_id IS NOT NULL
            UNION
            SELECT event_id, false FROM raw_checkouts WHERE {_recent("event_timestamp")} AND event_id IS NOT NULL))""",
    ),
    "clicks_per_checkout": (
        _WINDOW,
        f"""SELECT {_labels(CLICK_COUNT)} AS click_bucket, checkout_count
FROM (SELECT {_COUNT_RANK} AS bucket_rank, count(*) AS checkout_count
      FROM (SELECT checkout_id, count(*) AS clicks FROM ({_PAIRS}) GROUP BY checkout_id)
      GROUP BY {_COUNT_RANK})
ORDER BY bucket_rank""",
    ),
    "pipeline_health": (
        _CLOCK.format(hours=1),
        f"""SELECT 'Clicks (Last Hour)' AS metric, CAST(count(*) AS DOUBLE) AS value
FROM raw_clicks WHERE {_recent("event_timestamp")}
UNION ALL SELECT 'Checkouts (Last Hour)', CAST(count(*) AS DOUBLE) FROM raw_checkouts WHERE {_recent("event_timestamp")}
UNION ALL SELECT inline(both) FROM (
  SELECT array(struct('Attributed Checkouts (Last Hour)', CAST(count(*) AS DOUBLE)),
               struct('Total Revenue (Last Hour)', CAST(round(coalesce(sum(revenue), 0), 2) AS DOUBLE))) AS both
  FROM attributed_checkouts WHERE {_recent("checkout_timestamp")})""",
    ),
}


def register_reports(spark: SparkSession) -> None:
    """Define the reports as temporary table functions over the views of the stored tables."""
    for name, (parameters, body) in REPORTS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE RETURN {body}")
