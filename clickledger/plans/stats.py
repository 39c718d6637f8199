"""Row counts and short samples of stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 5


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) of each table."""
    counts = [
        table.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def table_sample(table: DataFrame, key: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """First rows of a table in key order, so that the sample is repeatable."""
    return table.orderBy(key).limit(rows)
