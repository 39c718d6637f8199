"""What a streaming query's checkpoint holds: rows of state by operator, read as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Stateful operators of a query by number, with their stores and the batches on record."""
    return spark.read.format("state-metadata").load(checkpoint)


def state_of(spark: SparkSession, checkpoint: str, operator: int, side: str | None = None, batch: int | None = None) -> DataFrame:
    """Keys and values of an operator's state after a batch, the last by default; joins have a ``left`` and a ``right`` side."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if side is not None:
        reader = reader.option("joinSide", side)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def state_rows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``operator, name, side, rows``: how much each operator holds after a batch."""
    known = {(r.operatorId, r.operatorName) for r in state_operators(spark, checkpoint).collect()}  # one row a store
    counts = []
    for operator, name in sorted(known):
        for side in ("left", "right") if "Join" in name else (None,):
            rows = state_of(spark, checkpoint, operator, side, batch).agg(F.count("*").alias("rows"))
            labels = [F.lit(operator).alias("operator"), F.lit(name).alias("name"), F.lit(side).cast("string").alias("side")]
            counts.append(rows.select(*labels, "rows"))
    if not counts:
        return spark.createDataFrame([], "operator INT, name STRING, side STRING, rows BIGINT")
    whole = counts[0]
    for one in counts[1:]:
        whole = whole.unionAll(one)
    return whole
