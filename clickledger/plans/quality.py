"""Table rules (unique keys, required columns, lengths, money range) as counted checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickledger.schemas import MONEY, TableRules


def audit_table(name: str, table: DataFrame, rules: TableRules) -> DataFrame:
    """(table_name, rule, column_name, violations), zero where the rule holds.

    A UNIQUE violation is one key value stored more than once. A required column or a key that the
    table lacks is violated by every row; length and money rules on absent columns are left out. All
    rules of a table share one scan and one shuffle: row checks are counted along with the keys.
    """
    keys = [c for c in rules.key if c in table.columns]
    checks = _row_checks(table, rules)
    counters = [F.count_if(failed).alias(f"c{n}") for n, (_, _, failed) in enumerate(checks)]
    by_key = table.groupBy(*keys).agg(F.count("*").alias("rows"), *counters)
    if len(keys) < len(rules.key):
        repeated = F.coalesce(F.sum("rows"), F.lit(0))
    else:
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
        repeated = F.count_if(present & (F.col("rows") > 1))
    results = [_result(name, "UNIQUE", ",".join(rules.key), repeated)]
    results += [
        _result(name, rule, column, F.coalesce(F.sum(f"c{n}"), F.lit(0)))
        for n, (rule, column, _) in enumerate(checks)
    ]
    return by_key.agg(F.array(*results).alias("results")).select(F.inline("results"))


def audit_constraints(tables: dict[str, tuple[DataFrame, TableRules]]) -> DataFrame:
    return reduce(
        DataFrame.unionAll, [audit_table(name, df, rules) for name, (df, rules) in tables.items()]
    )


def _row_checks(table: DataFrame, rules: TableRules) -> list[tuple[str, str, Column]]:
    stored = set(table.columns)
    checks = [
        ("NOT NULL", c, F.col(c).isNull() if c in stored else F.lit(True)) for c in rules.required
    ]
    checks += [
        ("MAX LENGTH", c, F.length(c) > n) for c, n in rules.max_length.items() if c in stored
    ]
    checks += [
        ("MONEY RANGE", c, F.col(c).isNotNull() & F.col(c).try_cast(MONEY).isNull())
        for c in rules.money
        if c in stored
    ]
    return checks


def _result(name: str, rule: str, column: str, violations: Column) -> Column:
    return F.struct(
        F.lit(name).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column_name"),
        violations.alias("violations"),
    )
