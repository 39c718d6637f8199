"""State of the pair join and of the final winner before and after the watermark passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickledger.sources.feeds import read_stream
from clickledger.streaming.attribution import final_winners, pair_stream
from clickledger.streaming.inspect import state_rows

CLICK = ["event_id", "product_id", "product_name", "product_category", "referrer", "device_type"]
SCHEMA = "event_id STRING, user_id STRING, at STRING, kind STRING"


def feed(spark, root, kind):
    stream = read_stream(spark, "parquet", root, SCHEMA, limit=1).where(F.col("kind") == kind)
    timed = stream.withColumn("event_timestamp", F.col("at").cast("timestamp"))
    if kind == "checkout":
        return timed.withColumn("total_amount", F.lit(5).cast("decimal(10,2)"))
    return timed.withColumns({c: F.lit("x") for c in CLICK[1:]})


def test_state_shrinks_when_the_watermark_passes(spark, tmp_path):
    root, checkpoint, table = (str(tmp_path / n) for n in ("feed", "checkpoint", "table"))

    def run(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(root)
        pairs = pair_stream(feed(spark, root, "click"), feed(spark, root, "checkout"))
        query = final_winners(pairs).writeStream.format("parquet").option("path", table)
        query = query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        held = {(r.name, r.side): 0 for r in state_rows(spark, checkpoint).collect()}
        for r in state_rows(spark, checkpoint).collect():
            held[r.name, r.side] += r.rows
        return held

    before = run(("c1", "u", "2024-01-01 10:00:00", "click"), ("c2", "v", "2024-01-01 10:05:00", "click"), ("k1", "u", "2024-01-01 10:10:00", "checkout"))
    join, winner = "symmetricHashJoin", "stateStoreSave"
    assert before[join, "left"] == 1 and before[join, "right"] == 2 and before[winner, None] == 1
    far = [("c8", "x", "2024-01-03 10:00:00", "click"), ("k8", "y", "2024-01-03 10:00:00", "checkout")]
    after = run(*far)
    assert after[join, "left"] == 1 and after[join, "right"] == 1 and after[winner, None] == 0
    assert [r.checkout_id for r in spark.read.parquet(table).collect()] == ["k1"]
