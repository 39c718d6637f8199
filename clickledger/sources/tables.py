"""Stored tables: Parquet folders, catalog tables, or a database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickledger.schemas import MONEY, RAW_CHECKOUT_COLUMNS, RAW_CLICK_COLUMNS, USER_SCHEMA


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    predicates: list[str] | None = None,
    column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Table scan over JDBC, in parallel by predicates or by ranges of a numeric or time column.

    ``bounds`` are the column's lowest and highest value and only place the cuts between ``partitions``
    ranges; rows outside them are read too. Without either the scan is one task.
    """
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    if column:
        return spark.read.jdbc(
            url, table, column, bounds[0], bounds[1], partitions, properties=properties
        )
    return spark.read.jdbc(url, table, properties=properties)


def register_views(**tables: DataFrame) -> None:
    """Name tables for ``spark.sql``, e.g. ``raw_clicks=…, attributed_checkouts=…, users=…``."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def raw_clicks(clicks: DataFrame) -> DataFrame:
    """Columns the raw click table stores."""
    return clicks.select(*RAW_CLICK_COLUMNS)


def raw_checkouts(checkouts: DataFrame) -> DataFrame:
    """Columns the raw checkout table stores, the total as an exact decimal."""
    return checkouts.withColumn("total_amount", F.col("total_amount").cast(MONEY)).select(
        *RAW_CHECKOUT_COLUMNS
    )


def with_load_time(table: DataFrame, *columns: str) -> DataFrame:
    """Fill the columns that default to the time of writing."""
    now = F.current_timestamp()
    return table.withColumns(
        {c: F.coalesce(F.col(c), now) if c in table.columns else now for c in columns}
    )


def users_from_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Users dimension from given rows, defaults filled in."""
    return user_defaults(spark.createDataFrame(rows, USER_SCHEMA))


def user_defaults(users: DataFrame) -> DataFrame:
    filled = users.withColumn(
        "lifetime_value", F.coalesce(F.col("lifetime_value"), F.lit("0.00").cast(MONEY))
    )
    return with_load_time(filled, "created_at", "updated_at")


def users_dimension(numbers: DataFrame, as_of, width: int = 5) -> DataFrame:
    """Users by rule from their number ``i``, age in days and lifetime value.

    Segments follow ``i % 3``; identifiers are padded to ``width`` digits, longer numbers stay whole.
    """
    i = F.col("i")
    text = i.cast("string")
    segment = (
        F.when(i % 3 == 0, "premium").when(i % 3 == 1, "regular").otherwise("new")
    )
    return numbers.select(
        F.concat(F.lit("USER-"), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))).alias("user_id"),
        F.concat(F.lit("user"), text, F.lit("@email.com")).alias("email"),
        F.concat(F.lit("FirstName"), text).alias("first_name"),
        F.concat(F.lit("LastName"), text).alias("last_name"),
        F.date_sub(F.lit(as_of), F.col("days_registered")).alias("registration_date"),
        segment.alias("customer_segment"),
        F.round(F.col("lifetime_value").cast(MONEY), 2).alias("lifetime_value"),
    )
