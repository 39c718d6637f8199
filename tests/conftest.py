from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from clickledger.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "clickledger-tests",
        "local[4]",
        streaming=True,
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def make_clicks(spark):
    """Clicks from (event_id, user_id, time text) rows; the product is named after the click."""

    def make(*rows):
        df = spark.createDataFrame(list(rows), "event_id STRING, user_id STRING, at STRING")
        return df.select(
            "event_id",
            "user_id",
            F.concat(F.lit("S-"), "event_id").alias("session_id"),
            F.concat(F.lit("P-"), "event_id").alias("product_id"),
            F.concat(F.lit("Product "), "event_id").alias("product_name"),
            F.lit("Books").alias("product_category"),
            F.lit("google").alias("referrer"),
            F.lit("mobile").alias("device_type"),
            F.col("at").cast("timestamp").alias("event_timestamp"),
        )

    return make


@pytest.fixture
def make_checkouts(spark):
    """Checkouts from (event_id, user_id, time text, amount text) rows."""

    def make(*rows):
        df = spark.createDataFrame(
            list(rows), "event_id STRING, user_id STRING, at STRING, amount STRING"
        )
        return df.select(
            "event_id",
            "user_id",
            F.concat(F.lit("S-"), "event_id").alias("session_id"),
            F.col("amount").cast("decimal(10,2)").alias("total_amount"),
            F.lit("paypal").alias("payment_method"),
            F.col("at").cast("timestamp").alias("event_timestamp"),
        )

    return make
