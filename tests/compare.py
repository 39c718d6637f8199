"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import contextlib
import datetime
import decimal
import io
import os

import duckdb

TABLES = "customer events lineitem orders part".split()


def oracle_connection(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def as_rows(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df) -> list[tuple]:
    return as_rows(df.columns, df.collect())


def oracle_rows(connection, sql: str) -> list[tuple]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    return as_rows(names, cursor.fetchall())


def column_names(connection, sql: str) -> list[str]:
    return sorted(d[0] for d in connection.execute(sql).description)


def plan_text(df) -> str:
    """Physical plan as ``explain`` prints it."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
