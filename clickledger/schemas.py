"""Wire schemas of the two event feeds and the rules of the stored tables.

Fixed values: field names, types, lengths and keys below are the public data contract of the feeds
and tables, so they are spelled out as they must be.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


def _struct(**fields: T.DataType) -> T.StructType:
    """All-nullable struct; wire records may lack any field."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT, _NUMBER = T.StringType(), T.DoubleType()

CLICK_SCHEMA = _struct(
    event_id=_TEXT,
    user_id=_TEXT,
    product_id=_TEXT,
    product_name=_TEXT,
    product_category=_TEXT,
    product_price=_NUMBER,
    timestamp=_TEXT,
    session_id=_TEXT,
    device_type=_TEXT,
    page_url=_TEXT,
    referrer=_TEXT,
)

ITEM_SCHEMA = _struct(
    product_id=_TEXT, product_name=_TEXT, price=_NUMBER, quantity=T.IntegerType()
)

CHECKOUT_SCHEMA = _struct(
    event_id=_TEXT,
    user_id=_TEXT,
    timestamp=_TEXT,
    session_id=_TEXT,
    items=T.ArrayType(ITEM_SCHEMA),
    total_amount=_NUMBER,
    payment_method=_TEXT,
)

USER_SCHEMA = _struct(
    user_id=_TEXT,
    email=_TEXT,
    first_name=_TEXT,
    last_name=_TEXT,
    registration_date=T.TimestampType(),
    customer_segment=_TEXT,
    lifetime_value=MONEY,
)

_TIME = T.TimestampType()
_CLICK = _struct(
    event_timestamp=_TIME,
    event_id=_TEXT,
    product_id=_TEXT,
    product_name=_TEXT,
    product_category=_TEXT,
    referrer=_TEXT,
    device_type=_TEXT,
)

# The tables that the streaming queries store.
EVENT_SCHEMA = _struct(
    user_id=_TEXT,
    event_timestamp=_TIME,
    click=_CLICK,
    checkout=_struct(event_id=_TEXT, total_amount=MONEY),
)
WINNER_SCHEMA = _struct(
    checkout_id=_TEXT, user_id=_TEXT, checkout_timestamp=_TIME, revenue=MONEY, click=_CLICK
)
ATTRIBUTED_SCHEMA = _struct(
    checkout_id=_TEXT,
    user_id=_TEXT,
    checkout_timestamp=_TIME,
    attributed_click_id=_TEXT,
    attributed_product_id=_TEXT,
    attributed_product_name=_TEXT,
    attributed_category=_TEXT,
    traffic_source=_TEXT,
    device_type=_TEXT,
    first_click_timestamp=_TIME,
    revenue=MONEY,
    attribution_window_seconds=T.LongType(),
    processed_at=_TIME,
)
RAW_CLICK_SCHEMA = _struct(
    event_id=_TEXT,
    user_id=_TEXT,
    session_id=_TEXT,
    product_id=_TEXT,
    product_category=_TEXT,
    referrer=_TEXT,
    device_type=_TEXT,
    event_timestamp=_TIME,
)
RAW_CHECKOUT_SCHEMA = _struct(
    event_id=_TEXT,
    user_id=_TEXT,
    session_id=_TEXT,
    total_amount=MONEY,
    payment_method=_TEXT,
    event_timestamp=_TIME,
)

RAW_CLICK_COLUMNS = RAW_CLICK_SCHEMA.names
RAW_CHECKOUT_COLUMNS = RAW_CHECKOUT_SCHEMA.names

CLICK_REQUIRED = ["event_id", "user_id", "product_id", "event_timestamp"]
CHECKOUT_REQUIRED = ["event_id", "user_id", "total_amount", "event_timestamp"]


@dataclass(frozen=True)
class TableRules:
    """Declared rules of one table: unique key, required columns, text lengths, money columns."""

    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    money: tuple[str, ...] = ()


RULES: dict[str, TableRules] = {
    "raw_clicks": TableRules(
        key=("event_id",),
        required=("event_id", "user_id", "product_id", "event_timestamp"),
        max_length={
            "event_id": 100,
            "user_id": 50,
            "product_id": 50,
            "product_category": 50,
            "referrer": 50,
            "device_type": 20,
        },
    ),
    "raw_checkouts": TableRules(
        key=("event_id",),
        required=("event_id", "user_id", "total_amount", "event_timestamp"),
        max_length={"event_id": 100, "user_id": 50, "payment_method": 50},
        money=("total_amount",),
    ),
    "attributed_checkouts": TableRules(
        key=("checkout_id",),
        required=(
            "checkout_id",
            "user_id",
            "checkout_timestamp",
            "attributed_click_id",
            "attributed_product_id",
            "first_click_timestamp",
            "revenue",
            "processed_at",
        ),
        max_length={
            "checkout_id": 100,
            "user_id": 50,
            "attributed_click_id": 100,
            "attributed_product_id": 50,
            "attributed_product_name": 200,
            "attributed_category": 50,
            "traffic_source": 50,
            "device_type": 20,
        },
        money=("revenue",),
    ),
    "users": TableRules(
        key=("user_id",),
        required=("user_id",),
        max_length={
            "user_id": 50,
            "email": 100,
            "first_name": 50,
            "last_name": 50,
            "customer_segment": 20,
        },
        money=("lifetime_value",),
    ),
    "mv_revenue_by_source": TableRules(key=("hour", "traffic_source")),
    "mv_category_performance": TableRules(key=("attributed_category",)),
    "mv_device_analysis": TableRules(key=("device_type",)),
}
