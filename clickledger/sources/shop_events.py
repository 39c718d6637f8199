"""The shared test tables seen as the shop's feeds and users.

The event table has numeric ids, a JSON ``props`` with a number ``k``, and event types; these rules
give it product, category, referrer, device and payment columns. Value lists are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.sources.feeds import read_stream

PRODUCTS = 50
CATEGORIES = ["Electronics", "Clothing", "Home", "Books", "Sports", "Toys", "Beauty", "Garden"]
REFERRERS = ["google", "facebook", "direct", "email", "organic"]
DEVICES = ["desktop", "mobile", "tablet"]
PAYMENTS = ["credit_card", "debit_card", "paypal", "apple_pay"]
COUNTRIES = ["US", "CA", "GB", "DE", "FR"]
USER_DIGITS = 9

# Column types of the tables used, so that no read has to look at file footers first.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def user_key(number: str) -> str:
    """SQL text of a user id made from a numeric column; numbers with more digits stay whole."""
    return f"concat('USER-', {padded(number, USER_DIGITS)})"


def padded(number: str, width: int) -> str:
    text = f"cast({number} AS STRING)"
    return f"lpad({text}, greatest(length({text}), {width}), '0')"


def _cycle(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), {index} % {len(values)} + 1)"


_SHARED = [
    "cast(event_id AS STRING) AS event_id",
    f"{user_key('user_id')} AS user_id",
    "concat('SESSION-', cast(event_id AS STRING)) AS session_id",
    "ts AS event_timestamp",
]
_CLICK_COLUMNS = [
    *_SHARED,
    f"concat('PROD-', {padded('product + 1', 4)}) AS product_id",
    "concat('Product ', cast(product + 1 AS STRING)) AS product_name",
    f"{_cycle(CATEGORIES, 'product')} AS product_category",
    f"{_cycle(REFERRERS, 'k')} AS referrer",
    f"{_cycle(DEVICES, 'k')} AS device_type",
    "value AS product_price",
]
_CHECKOUT_COLUMNS = [
    *_SHARED,
    "cast(value AS DECIMAL(10,2)) AS total_amount",
    f"{_cycle(PAYMENTS, 'k')} AS payment_method",
]


def shape_clicks(events: DataFrame) -> DataFrame:
    return (
        _with_k(events, "click")
        .selectExpr("*", f"k % {PRODUCTS} AS product")
        .selectExpr(*_CLICK_COLUMNS)
    )


def shape_checkouts(events: DataFrame) -> DataFrame:
    return _with_k(events, "purchase").selectExpr(*_CHECKOUT_COLUMNS)


def _with_k(events: DataFrame, event_type: str) -> DataFrame:
    k = "cast(get_json_object(props, '$.k') AS INT) AS k"
    return events.where(f"event_type = '{event_type}'").selectExpr(
        "event_id", "ts", "user_id", "value", k
    )


def clicks(spark: SparkSession, folder: str) -> DataFrame:
    return shape_clicks(table(spark, folder, "events"))


def checkouts(spark: SparkSession, folder: str) -> DataFrame:
    return shape_checkouts(table(spark, folder, "events"))


def users(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(
        f"{user_key('c_custkey')} AS user_id",
        "c_mktsegment AS customer_segment",
        "cast(c_acctbal AS DECIMAL(10,2)) AS lifetime_value",
    )


def clock(spark: SparkSession, folder: str) -> Callable[[timedelta], Column]:
    """The latest event stands for now: gives the time so long before it, as a scalar subquery."""
    return lambda back: table(spark, folder, "events").agg(F.max("ts") - F.lit(back)).scalar()


#: The feed's deliveries: how many, in files how many each, and how far events may lag behind.
DROPS, FILES, LAG, DELAY = 8, 4, timedelta(hours=6), "12 hours"


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """The event table with ``drop``, the delivery each event comes in, repeats included.

    Deliveries are equal spans of time. A third of what happens less than LAG before a delivery's end
    comes with the next one; one in 50 comes three deliveries late, behind any watermark of DELAY; one in
    10 comes twice, and one in 11 again with the next delivery.
    """
    events = table(spark, folder, "events")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    since = f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'{first}', {{}})"
    span = F.expr(f"{since.format(f"TIMESTAMP_NTZ'{last}'")} + 1")
    passed = F.expr(since.format("ts"))

    def drop_at(microseconds: Column) -> Column:
        return F.floor(microseconds * DROPS / span).cast("int")

    on_time, lagging = drop_at(passed), drop_at(passed + int(LAG.total_seconds()) * 1_000_000)
    number, end = F.col("event_id"), F.lit(DROPS - 1)
    late = (number % 50 == 7) & (on_time <= DROPS - 4)
    held = (number % 3 == 1) & (lagging > on_time) & (on_time < end)
    drop = F.when(late, on_time + 3).when(held, on_time + 1).otherwise(on_time)
    again = F.array(drop, F.when(number % 10 == 3, drop), F.when(number % 11 == 5, F.least(drop + 1, end)))
    return events.withColumn("drop", F.explode(F.array_compact(again)))


def deliver(spark: SparkSession, folder: str, path: str, closing: bool = False) -> None:
    """Write the deliveries to ``path`` one after another, as a file source would find them.

    ``closing`` adds a last one, of events far ahead by a user of their own, which closes all windows.
    """
    delivered = deliveries(spark, folder)
    parts = [delivered.where(F.col("drop") == k).drop("drop") for k in range(DROPS)]
    if closing:
        last = table(spark, folder, "events").agg((F.max("ts") + F.expr("INTERVAL 60 DAYS")).alias("ts"))
        kinds = F.explode(F.array(F.lit("click"), F.lit("purchase")))
        row = last.select(F.explode(F.sequence(F.lit(1), F.lit(4 * FILES))).alias("i"), "ts").select("i", "ts", kinds.alias("event_type"))
        away = row.selectExpr("-2 * i - int(event_type = 'click') AS event_id", "ts", "-i AS user_id", "event_type", "1.0D AS value", "'{\"k\": 0}' AS props")
        # Purchases before clicks: none of these is attributed.
        parts.append(away.withColumn("ts", F.when(F.col("event_type") == "click", F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts"))))
    for part in parts:
        columns = [F.col(f.name).cast(f.dataType) for f in delivered.drop("drop").schema]
        part.select(*columns).repartition(FILES).write.mode("append").parquet(path)


def delivered_stream(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`deliver` wrote, one delivery a micro-batch, with instants for times."""
    stream = read_stream(spark, "parquet", path, SCHEMAS["events"], limit=FILES)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))
