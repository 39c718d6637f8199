"""SQL text that another engine runs on the same tables, one per named query.

Averages a report rounds to two digits are computed in whole cents with integer division, so that half
cents round up exactly as they do in decimal arithmetic.
"""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INT)"
AS_OF = "(SELECT max(ts) FROM events)"

FEEDS = f"""
raw_clicks AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         concat('USER-', lpad(CAST(user_id AS VARCHAR), greatest(length(CAST(user_id AS VARCHAR)), 9)::INTEGER, '0')) AS user_id,
         concat('SESSION-', CAST(event_id AS VARCHAR)) AS session_id,
         concat('PROD-', lpad(CAST({K} % 50 + 1 AS VARCHAR), 4, '0')) AS product_id,
         concat('Product ', CAST({K} % 50 + 1 AS VARCHAR)) AS product_name,
         CASE ({K} % 50) % 8 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Clothing' WHEN 2 THEN 'Home'
              WHEN 3 THEN 'Books' WHEN 4 THEN 'Sports' WHEN 5 THEN 'Toys' WHEN 6 THEN 'Beauty'
              ELSE 'Garden' END AS product_category,
         CASE {K} % 5 WHEN 0 THEN 'google' WHEN 1 THEN 'facebook' WHEN 2 THEN 'direct'
              WHEN 3 THEN 'email' ELSE 'organic' END AS referrer,
         CASE {K} % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_type,
         ts AS event_timestamp,
         value AS product_price
  FROM events WHERE event_type = 'click'),
raw_checkouts AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         concat('USER-', lpad(CAST(user_id AS VARCHAR), greatest(length(CAST(user_id AS VARCHAR)), 9)::INTEGER, '0')) AS user_id,
         concat('SESSION-', CAST(event_id AS VARCHAR)) AS session_id,
         CAST(value AS DECIMAL(10,2)) AS total_amount,
         CASE {K} % 4 WHEN 0 THEN 'credit_card' WHEN 1 THEN 'debit_card' WHEN 2 THEN 'paypal'
              ELSE 'apple_pay' END AS payment_method,
         ts AS event_timestamp
  FROM events WHERE event_type = 'purchase'),
users AS (
  SELECT concat('USER-', lpad(CAST(c_custkey AS VARCHAR), greatest(length(CAST(c_custkey AS VARCHAR)), 9)::INTEGER, '0')) AS user_id,
         c_mktsegment AS customer_segment,
         CAST(c_acctbal AS DECIMAL(10,2)) AS lifetime_value
  FROM customer)
"""


def with_feeds(body: str) -> str:
    return f"WITH {FEEDS}\n{body}"


# The deliveries of the streaming queries: one event in 50 of the first five spans comes behind the watermark.
LATE = """event_id % 50 = 7 AND floor((epoch_us(ts) - epoch_us((SELECT min(ts) FROM events))) * 8
    / (epoch_us((SELECT max(ts) FROM events)) - epoch_us((SELECT min(ts) FROM events)) + 1)) <= 4"""


def on_time(sql: str) -> str:
    """The SQL over the events that come before the watermark has passed them."""
    taken = f"FROM (SELECT * FROM events WHERE NOT ({LATE})) AS on_time WHERE"
    return sql.replace("FROM events WHERE event_type", f"{taken} event_type")


def with_attributed(body: str, window: str = "1 hour") -> str:
    seconds = (
        "CAST(floor(epoch(checkout_timestamp)) AS BIGINT)"
        " - CAST(floor(epoch(first_click_timestamp)) AS BIGINT)"
    )
    return f"""WITH {FEEDS},
ranked AS (
  SELECT co.event_id AS checkout_id, co.user_id, co.event_timestamp AS checkout_timestamp,
         cl.event_id AS attributed_click_id, cl.product_id AS attributed_product_id,
         cl.product_name AS attributed_product_name, cl.product_category AS attributed_category,
         cl.referrer AS traffic_source, cl.device_type AS device_type,
         cl.event_timestamp AS first_click_timestamp, co.total_amount AS revenue,
         row_number() OVER (PARTITION BY co.event_id
                            ORDER BY cl.event_timestamp, cl.event_id) AS click_rank
  FROM raw_checkouts co
  JOIN raw_clicks cl ON co.user_id = cl.user_id
   AND cl.event_timestamp <= co.event_timestamp
   AND cl.event_timestamp >= co.event_timestamp - INTERVAL {window}),
attributed AS (
  SELECT * EXCLUDE (click_rank), {seconds} AS attribution_window_seconds
  FROM ranked WHERE click_rank = 1)
{body}"""


def amount(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def average(column: str) -> str:
    return f"ROUND(CAST(SUM({column}) AS DOUBLE) / COUNT({column}), 6)"


def cents(column: str) -> str:
    return f"CAST(SUM(CAST({column} * 100 AS BIGINT)) AS HUGEINT)"


def half_up(numerator: str, denominator: str) -> str:
    """numerator / denominator rounded half up to two digits, both whole and not negative."""
    return (
        f"CAST((200 * {numerator} + {denominator}) // NULLIF(2 * {denominator}, 0) AS DOUBLE) / 100"
    )


def cents_average(column: str) -> str:
    n = f"COUNT({column})"
    return f"CAST((2 * {cents(column)} + {n}) // (2 * {n}) AS DOUBLE) / 100"


FIRST_CLICK = """SELECT checkout_id, user_id, checkout_timestamp, attributed_click_id,
       attributed_product_id, attributed_product_name, attributed_category, traffic_source,
       device_type, first_click_timestamp, CAST(revenue AS DOUBLE) AS revenue,
       attribution_window_seconds
FROM attributed"""

REVENUE_BY_SOURCE = f"""SELECT traffic_source, COUNT(*) AS total_conversions,
       {amount("SUM(revenue)")} AS total_revenue, {average("revenue")} AS avg_order_value,
       {half_up("100 * " + cents("revenue"), f"SUM({cents('revenue')}) OVER ()")}
         AS revenue_percentage
FROM attributed GROUP BY traffic_source ORDER BY total_revenue DESC"""

TIME_TO_PURCHASE = f"""SELECT time_bucket, conversion_count, avg_revenue FROM (
  SELECT CASE WHEN attribution_window_seconds < 300 THEN '< 5 minutes'
              WHEN attribution_window_seconds < 900 THEN '5-15 minutes'
              WHEN attribution_window_seconds < 1800 THEN '15-30 minutes'
              WHEN attribution_window_seconds < 3600 THEN '30-60 minutes'
              ELSE '> 1 hour' END AS time_bucket,
         COUNT(*) AS conversion_count, {cents_average("revenue")} AS avg_revenue,
         MIN(attribution_window_seconds) AS least
  FROM attributed GROUP BY 1) ORDER BY least"""

CATEGORY = f"""SELECT attributed_category, COUNT(*) AS conversion_count,
       {amount("SUM(revenue)")} AS total_revenue, {average("revenue")} AS avg_order_value,
       COUNT(DISTINCT user_id) AS unique_customers
FROM attributed GROUP BY attributed_category ORDER BY total_revenue DESC, attributed_category"""

DEVICE_CONVERSION = f"""SELECT device_type, COUNT(*) AS conversions,
       {amount("SUM(revenue)")} AS total_revenue, {cents_average("revenue")} AS avg_order_value,
       {half_up("CAST(SUM(attribution_window_seconds) AS HUGEINT)",
                "(60 * COUNT(attribution_window_seconds))")} AS avg_minutes_to_purchase
FROM attributed GROUP BY device_type ORDER BY total_revenue DESC"""

SEGMENT = f"""SELECT customer_segment, COUNT(DISTINCT a.checkout_id) AS total_orders,
       COUNT(DISTINCT a.user_id) AS active_customers, {amount("SUM(a.revenue)")} AS total_revenue,
       {average("a.revenue")} AS avg_order_value,
       ROUND(CAST(SUM(a.revenue) AS DOUBLE) / COUNT(DISTINCT a.user_id), 6) AS revenue_per_customer
FROM attributed a JOIN users u ON a.user_id = u.user_id
GROUP BY customer_segment ORDER BY total_revenue DESC"""

TOP_PRODUCTS = f"""SELECT attributed_product_id, attributed_product_name, attributed_category,
       COUNT(*) AS conversion_count, {amount("SUM(revenue)")} AS total_attributed_revenue
FROM attributed GROUP BY 1, 2, 3
ORDER BY conversion_count DESC, SUM(revenue) DESC, 1, 2, 3 LIMIT 20"""

CLICK_RATE = f"""SELECT total_clicks, total_checkouts,
       {half_up("CAST(100 * total_checkouts AS HUGEINT)", "total_clicks")} AS conversion_rate
FROM (SELECT COUNT(DISTINCT event_id) AS total_clicks FROM raw_clicks
      WHERE event_timestamp >= {AS_OF} - INTERVAL 1 hour),
     (SELECT COUNT(DISTINCT event_id) AS total_checkouts FROM raw_checkouts
      WHERE event_timestamp >= {AS_OF} - INTERVAL 1 hour)"""

HEALTH = f"""SELECT 'Clicks (Last Hour)' AS metric, CAST(COUNT(*) AS DOUBLE) AS value
FROM raw_clicks WHERE event_timestamp >= {AS_OF} - INTERVAL 1 hour
UNION ALL
SELECT 'Checkouts (Last Hour)', CAST(COUNT(*) AS DOUBLE)
FROM raw_checkouts WHERE event_timestamp >= {AS_OF} - INTERVAL 1 hour
UNION ALL
SELECT 'Attributed Checkouts (Last Hour)', CAST(COUNT(*) AS DOUBLE)
FROM attributed WHERE checkout_timestamp >= {AS_OF} - INTERVAL 1 hour
UNION ALL
SELECT 'Total Revenue (Last Hour)', CAST(COALESCE(SUM(revenue), 0) AS DOUBLE)
FROM attributed WHERE checkout_timestamp >= {AS_OF} - INTERVAL 1 hour"""

MV_SOURCE = f"""SELECT date_trunc('hour', checkout_timestamp) AS hour, traffic_source,
       COUNT(*) AS checkout_count, {amount("SUM(revenue)")} AS total_revenue,
       {average("revenue")} AS avg_revenue,
       {average("attribution_window_seconds")} AS avg_attribution_window
FROM attributed GROUP BY 1, 2 ORDER BY hour DESC, total_revenue DESC"""

MV_DEVICE = f"""SELECT device_type, COUNT(*) AS conversion_count,
       {amount("SUM(revenue)")} AS total_revenue, {average("revenue")} AS avg_order_value,
       ROUND(CAST(SUM(attribution_window_seconds) AS DOUBLE)
             / COUNT(attribution_window_seconds) / 60, 6) AS avg_time_to_purchase_minutes
FROM attributed GROUP BY device_type ORDER BY total_revenue DESC"""

RAW_CLICKS = """SELECT event_id, user_id, session_id, product_id, product_category, referrer,
       device_type, event_timestamp FROM raw_clicks"""

RAW_CHECKOUTS = """SELECT event_id, user_id, session_id,
       CAST(total_amount AS DOUBLE) AS total_amount, payment_method, event_timestamp
FROM raw_checkouts"""


def pairs(window: str) -> str:
    return with_feeds(f"""SELECT co.event_id AS checkout_event_id, co.user_id AS checkout_user_id,
       co.event_timestamp AS checkout_event_timestamp,
       CAST(co.total_amount AS DOUBLE) AS checkout_total_amount, cl.event_id AS click_event_id,
       cl.product_id AS click_product_id, cl.product_name AS click_product_name,
       cl.product_category AS click_product_category, cl.referrer AS click_referrer,
       cl.device_type AS click_device_type, cl.event_timestamp AS click_event_timestamp
FROM raw_checkouts co
JOIN raw_clicks cl ON co.user_id = cl.user_id
 AND cl.event_timestamp <= co.event_timestamp
 AND cl.event_timestamp >= co.event_timestamp - INTERVAL {window}""")


def click_counts(window: str) -> str:
    return f"""WITH {FEEDS},
counts AS (
  SELECT co.event_id AS checkout_id, co.user_id, COUNT(*) AS total_clicks_in_window
  FROM raw_checkouts co
  JOIN raw_clicks cl ON co.user_id = cl.user_id
   AND cl.event_timestamp <= co.event_timestamp
   AND cl.event_timestamp >= co.event_timestamp - INTERVAL {window}
  GROUP BY co.event_id, co.user_id)
"""


def clicks_per_checkout(window: str) -> str:
    return click_counts(window) + """SELECT click_bucket, COUNT(*) AS checkout_count FROM (
  SELECT CASE WHEN total_clicks_in_window = 1 THEN '1 click'
              WHEN total_clicks_in_window BETWEEN 2 AND 3 THEN '2-3 clicks'
              WHEN total_clicks_in_window BETWEEN 4 AND 6 THEN '4-6 clicks'
              ELSE '7+ clicks' END AS click_bucket
  FROM counts) GROUP BY click_bucket ORDER BY click_bucket"""


def hourly(hours: int) -> str:
    return with_attributed(f"""SELECT date_trunc('hour', checkout_timestamp) AS hour,
       COUNT(*) AS conversions, {amount("SUM(revenue)")} AS hourly_revenue,
       {average("revenue")} AS avg_order_value
FROM attributed WHERE checkout_timestamp >= {AS_OF} - INTERVAL {hours} hour
GROUP BY 1 ORDER BY hour DESC""")


def sample(table: str, key: str, time: str) -> str:
    return f"""SELECT '{table}' AS table_name, {key} AS row_key, user_id, {time} AS event_timestamp
FROM (SELECT * FROM {'attributed' if table == 'attributed_checkouts' else table}
      ORDER BY {key} LIMIT 5)"""


# (table, key, required columns, column lengths, money columns) as the table rules state them.
USERS_DIMENSION = """SELECT concat('USER-', lpad(CAST(c_custkey AS VARCHAR), greatest(length(CAST(c_custkey AS VARCHAR)), 9)::INTEGER, '0')) AS user_id,
       concat('user', CAST(c_custkey AS VARCHAR), '@email.com') AS email,
       concat('FirstName', CAST(c_custkey AS VARCHAR)) AS first_name,
       concat('LastName', CAST(c_custkey AS VARCHAR)) AS last_name,
       DATE '2024-01-31' - CAST(c_custkey % 731 AS INTEGER) AS registration_date,
       CASE c_custkey % 3 WHEN 0 THEN 'premium' WHEN 1 THEN 'regular' ELSE 'new' END
         AS customer_segment,
       CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS DOUBLE) AS lifetime_value
FROM customer"""

_AUDITED = [
    (
        "raw_clicks",
        "event_id",
        ["event_id", "user_id", "product_id", "event_timestamp"],
        {
            "event_id": 100,
            "user_id": 50,
            "product_id": 50,
            "product_category": 50,
            "referrer": 50,
            "device_type": 20,
        },
        [],
    ),
    (
        "raw_checkouts",
        "event_id",
        ["event_id", "user_id", "total_amount", "event_timestamp"],
        {"event_id": 100, "user_id": 50, "payment_method": 50},
        ["total_amount"],
    ),
    (
        "attributed_checkouts",
        "checkout_id",
        [
            "checkout_id",
            "user_id",
            "checkout_timestamp",
            "attributed_click_id",
            "attributed_product_id",
            "first_click_timestamp",
            "revenue",
            "processed_at",
        ],
        {
            "checkout_id": 100,
            "user_id": 50,
            "attributed_click_id": 100,
            "attributed_product_id": 50,
            "attributed_product_name": 200,
            "attributed_category": 50,
            "traffic_source": 50,
            "device_type": 20,
        },
        ["revenue"],
    ),
    (
        "users",
        "user_id",
        ["user_id"],
        {"user_id": 50, "email": 100, "first_name": 50, "last_name": 50, "customer_segment": 20},
        ["lifetime_value"],
    ),
    ("mv_revenue_by_source", "hour,traffic_source", [], {}, []),
    ("mv_category_performance", "attributed_category", [], {}, []),
    ("mv_device_analysis", "device_type", [], {}, []),
    (
        "event_feed",
        "event_id",
        ["event_id", "user_id", "ts", "session_id"],
        {"event_type": 5},
        ["amount"],
    ),
]


def audit() -> str:
    parts = []
    for table, key, required, lengths, money in _AUDITED:
        present = " AND ".join(f"{k} IS NOT NULL" for k in key.split(","))
        source = "users_table" if table == "users" else table
        absent = ["session_id"] if table == "event_feed" else []
        checks = [("NOT NULL", c, "TRUE" if c in absent else f"{c} IS NULL") for c in required]
        checks += [("MAX LENGTH", c, f"length({c}) > {n}") for c, n in lengths.items()]
        checks += [
            ("MONEY RANGE", c, f"{c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL(10,2)) IS NULL")
            for c in money
        ]
        parts.append(f"""SELECT '{table}' AS table_name, 'UNIQUE' AS rule, '{key}' AS column_name,
       COUNT(*) AS violations
FROM (SELECT {key} FROM {source} WHERE {present} GROUP BY {key} HAVING COUNT(*) > 1)""")
        parts += [
            f"SELECT '{table}', '{rule}', '{column}', COUNT(*) FROM {source} WHERE {failed}"
            for rule, column, failed in checks
        ]
    tables = f""", attributed_checkouts AS (SELECT *, now() AS processed_at FROM attributed),
mv_revenue_by_source AS ({MV_SOURCE}),
mv_category_performance AS ({CATEGORY}),
mv_device_analysis AS ({MV_DEVICE}),
users_table AS ({USERS_DIMENSION}),
event_feed AS (
  SELECT event_id, ts, CASE WHEN user_id % 7 > 0 THEN user_id END AS user_id, event_type,
    value * 1e6 AS amount
  FROM (SELECT * FROM events UNION ALL SELECT * FROM events)
)
"""
    text = with_attributed("")
    return text.rstrip() + tables + "\nUNION ALL\n".join(parts)


ORACLE: dict[str, str] = {
    "parse_clicks": with_feeds("""SELECT event_id, user_id, product_id, product_name,
       product_category, product_price, session_id, device_type,
       concat('/products/', product_id) AS page_url, referrer, event_timestamp FROM raw_clicks"""),
    "parse_checkouts_nested": """SELECT CAST(o_orderkey AS VARCHAR) AS event_id,
       concat('USER-', lpad(CAST(o_custkey AS VARCHAR), greatest(length(CAST(o_custkey AS VARCHAR)), 9)::INTEGER, '0')) AS user_id,
       o_orderdate AS event_timestamp,
       CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS total_amount,
       COUNT(*) AS item_count, CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_quantity,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS items_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
GROUP BY o_orderkey, o_custkey, o_orderdate, o_totalprice""",
    "shipped_by_country": """SELECT CASE o_custkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'CA' WHEN 2 THEN 'GB'
       WHEN 3 THEN 'DE' ELSE 'FR' END AS country, COUNT(*) AS checkouts,
       COUNT(DISTINCT o_custkey % 100000) AS postal_codes, CAST(0 AS BIGINT) AS streets,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(10,2))) AS DOUBLE) AS revenue
FROM orders WHERE EXISTS (SELECT 1 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey = o_orderkey)
GROUP BY 1""",
    "raw_clicks": with_feeds(RAW_CLICKS),
    "raw_checkouts": with_feeds(RAW_CHECKOUTS),
    "dedup_events": """SELECT DISTINCT * FROM
  (SELECT * FROM events UNION ALL SELECT * FROM events)""",
    "attribution_pairs": pairs("1 hour"),
    "attribution_pairs_24h": pairs("24 hour"),
    "clicks_in_window": click_counts("1 hour") + "SELECT * FROM counts",
    "clicks_in_window_24h": click_counts("24 hour") + "SELECT * FROM counts",
    "first_click_attribution": with_attributed(FIRST_CLICK),
    "first_click_attribution_24h": with_attributed(FIRST_CLICK, "24 hour"),
    "revenue_by_source": with_attributed(REVENUE_BY_SOURCE),
    "revenue_by_source_24h": with_attributed(REVENUE_BY_SOURCE, "24 hour"),
    "time_to_purchase": with_attributed(TIME_TO_PURCHASE),
    "time_to_purchase_24h": with_attributed(TIME_TO_PURCHASE, "24 hour"),
    "category_performance": with_attributed(CATEGORY + " LIMIT 10"),
    "category_performance_24h": with_attributed(CATEGORY + " LIMIT 10", "24 hour"),
    "device_conversion": with_attributed(DEVICE_CONVERSION),
    "device_conversion_24h": with_attributed(DEVICE_CONVERSION, "24 hour"),
    "hourly_revenue": hourly(24),
    "hourly_revenue_720h": hourly(720),
    "segment_performance": with_attributed(SEGMENT),
    "top_products": with_attributed(TOP_PRODUCTS),
    "top_products_24h": with_attributed(TOP_PRODUCTS, "24 hour"),
    "click_to_checkout_rate": with_feeds(CLICK_RATE),
    "stored_click_to_checkout_rate": with_feeds(CLICK_RATE),
    "stored_pairs_of_a_payment": pairs("24 hour").replace(" cl.product_name AS click_product_name,", "") + f"""
WHERE co.payment_method = 'paypal' AND co.event_timestamp >= {AS_OF} - INTERVAL 24 hour""",
    "colocated_first_click_attribution": with_attributed(FIRST_CLICK),
    "colocated_attribution_pairs": pairs("1 hour"),
    "colocated_segment_performance": with_attributed(SEGMENT),
    "clicks_per_checkout": clicks_per_checkout("1 hour"),
    "clicks_per_checkout_24h": clicks_per_checkout("24 hour"),
    "clicks_per_checkout_30d": clicks_per_checkout("30 day"),
    "pipeline_health": with_attributed(HEALTH),
    "mv_revenue_by_source": with_attributed(MV_SOURCE),
    "mv_category_performance": with_attributed(CATEGORY),
    "mv_device_analysis": with_attributed(MV_DEVICE),
    "refresh_summaries": with_attributed(MV_SOURCE),
    "users_dimension": USERS_DIMENSION,
    "users_by_segment": with_feeds(f"""SELECT customer_segment, COUNT(*) AS user_count,
       {average("lifetime_value")} AS avg_lifetime_value,
       {amount("SUM(lifetime_value)")} AS total_lifetime_value
FROM users GROUP BY customer_segment ORDER BY total_lifetime_value DESC"""),
    "seed_summary": with_feeds("""SELECT 'Seed data inserted successfully!' AS status,
       (SELECT COUNT(*) FROM users) AS total_users"""),
    "table_stats": with_attributed("""SELECT 'raw_clicks' AS table_name, COUNT(*) AS row_count
FROM raw_clicks
UNION ALL SELECT 'raw_checkouts', COUNT(*) FROM raw_checkouts
UNION ALL SELECT 'attributed_checkouts', COUNT(*) FROM attributed"""),
    "table_sample": with_attributed(
        "\nUNION ALL\n".join(
            [
                sample("raw_clicks", "event_id", "event_timestamp"),
                sample("raw_checkouts", "event_id", "event_timestamp"),
                sample("attributed_checkouts", "checkout_id", "checkout_timestamp"),
            ]
        )
    ),
    "audit_constraints": audit(),
    "streaming_attribution": on_time(with_attributed(FIRST_CLICK)),
    "streaming_attribution_24h": on_time(with_attributed(FIRST_CLICK, "24 hour")),
    "streaming_final_winner": on_time(with_attributed(FIRST_CLICK)),
    "streaming_pairs": on_time(with_attributed("""SELECT checkout_id, user_id, checkout_timestamp,
       CAST(revenue AS DOUBLE) AS revenue, attributed_click_id AS click_id FROM ranked""")),
    "streaming_checkout_outcomes": with_attributed(f"""SELECT outcome, COUNT(*) AS checkouts,
       {amount("SUM(total_amount)")} AS revenue
FROM (SELECT r.total_amount, CASE WHEN late.id IS NOT NULL THEN 'late' WHEN a.checkout_id IS NULL THEN 'unmatched'
        ELSE 'attributed' END AS outcome
      FROM raw_checkouts r LEFT JOIN attributed_on_time a ON r.event_id = a.checkout_id
      LEFT JOIN (SELECT CAST(event_id AS VARCHAR) AS id FROM events WHERE {LATE}) AS late ON r.event_id = late.id)
GROUP BY outcome""").replace("\nattributed AS (", f"""
attributed_on_time AS (SELECT DISTINCT checkout_id FROM ranked
  WHERE checkout_id NOT IN (SELECT CAST(event_id AS VARCHAR) FROM events WHERE {LATE})
    AND attributed_click_id NOT IN (SELECT CAST(event_id AS VARCHAR) FROM events WHERE {LATE})),
attributed AS ("""),
    "refresh_summaries_incremental": on_time(with_attributed(MV_SOURCE)),
    "category_performance_merged": with_attributed(CATEGORY),
    "segment_performance_merged": with_attributed(SEGMENT),
    "streaming_raw_clicks": with_feeds(RAW_CLICKS),
    "streaming_raw_checkouts": with_feeds(RAW_CHECKOUTS),
}

# The reports called by name in SQL are checked against the same text as the others.
ORACLE |= {
    f"sql_{name}": ORACLE[name]
    for name in (
        "revenue_by_source",
        "time_to_purchase",
        "category_performance",
        "device_conversion",
        "hourly_revenue_720h",
        "segment_performance",
        "top_products",
        "click_to_checkout_rate",
        "clicks_per_checkout_24h",
        "pipeline_health",
    )
}
