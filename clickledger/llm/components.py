"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickledger.llm.common import stage


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; a component is named by its least node.

    Each round takes the least label among a node's neighbours and then the label of its label, so a
    chain of n links needs about log n rounds. Rounds are written to the shared folder; the driver
    sees one number a round. Repeated links and self links are harmless; no links give no rows.
    """
    flipped = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    edges = stage(links.select("a", "b").unionAll(flipped).distinct(), "edges", narrow=True)
    labels = edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("component")
    )
    labels = stage(labels, "labels", narrow=True)
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        nearest = edges.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        step = labels.join(nearest, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("component")
        )
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        step = stage(
            step.join(jump, "component").select("node", "was", F.col("further").alias("component")), "labels", narrow=True
        )
        if step.filter("was <> component").isEmpty():
            return step.select("node", "component")
        labels = step.select("node", "component")
