"""Decoding of wire records and quarantine."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

import compare
from clickledger.schemas import CHECKOUT_SCHEMA, CLICK_SCHEMA
from clickledger.sources.feeds import decode, valid_checkouts, valid_clicks


def click(**changes) -> str:
    record = {
        "event_id": "c1",
        "user_id": "u1",
        "product_id": "p1",
        "product_price": 9.99,
        "timestamp": "2024-01-01T10:00:00.250000Z",
    }
    return json.dumps(record | changes)


def feed(spark, *texts):
    return spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "data BINARY")


def test_times_with_and_without_fraction(spark):
    texts = [click(), click(timestamp="2024-01-01T00:00:00Z"), click(timestamp="yesterday")]
    times = [r.event_timestamp for r in decode(feed(spark, *texts), CLICK_SCHEMA).collect()]
    assert times == [datetime(2024, 1, 1, 10, 0, 0, 250000), datetime(2024, 1, 1), None]


def test_instants_do_not_depend_on_the_session_zone(spark):
    decoded = decode(feed(spark, click()), CLICK_SCHEMA).select(
        F.unix_micros("event_timestamp").alias("us")
    )
    expected = decoded.first().us
    spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
    try:
        again = decode(feed(spark, click()), CLICK_SCHEMA).select(
            F.unix_micros("event_timestamp").alias("us")
        )
        assert again.first().us == expected == 1704103200250000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bad_records_are_set_apart_and_nothing_is_lost(spark):
    texts = [
        click(),
        "{broken",
        click(event_id="c2", extra={"city": "X"}),
        click(event_id="c3", product_price="cheap"),
        click(event_id="c4", timestamp="never"),
    ]
    valid, bad = valid_clicks(decode(feed(spark, *texts), CLICK_SCHEMA))
    rows = {r.event_id: r for r in valid.collect()}
    assert set(rows) == {"c1", "c2", "c3"}
    assert rows["c3"].product_price is None and rows["c3"].user_id == "u1"
    assert "_corrupt_record" not in valid.columns
    apart = bad.collect()
    assert len(apart) == 2
    assert "{broken" in [r._corrupt_record for r in apart]


def test_nested_items(spark):
    record = {
        "event_id": "k1",
        "user_id": "u1",
        "timestamp": "2024-01-01T10:00:00Z",
        "items": [
            {"product_id": "p1", "product_name": "A", "price": 1.5, "quantity": 1},
            {"product_id": "p2", "product_name": "B", "price": 2.25, "quantity": 3},
        ],
        "total_amount": 8.25,
        "payment_method": "paypal",
        "shipping_address": {"city": "X"},
    }
    huge = record | {"event_id": "k2", "total_amount": 1e12}
    decoded = decode(feed(spark, json.dumps(record), json.dumps(huge)), CHECKOUT_SCHEMA)
    valid, bad = valid_checkouts(decoded)
    row = valid.first()
    assert [(i.product_id, i.quantity) for i in row["items"]] == [("p1", 1), ("p2", 3)]
    assert str(row.total_amount) == "8.25"
    assert "shipping_address" not in valid.columns
    assert [(r.event_id, r.total_amount) for r in bad.collect()] == [("k2", 1e12)]


def test_one_parse_per_record(spark):
    """Filters on parsed columns stay above the generator, so the text is parsed once."""
    valid, _ = valid_clicks(decode(feed(spark, click()), CLICK_SCHEMA))
    assert compare.plan_text(valid).count("from_json") == 1
