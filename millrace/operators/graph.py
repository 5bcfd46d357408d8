"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.tables import Scratch, discard


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b: long); label is the smallest node reachable.

    Each round takes the smallest label around every node, then follows labels
    once more (pointer jumping), so chains shrink by half. Every round's table is
    written; nothing but a flag comes to the driver. Nodes without edges, null
    ones too, are not in the result.
    """
    table = Scratch()
    pairs = edges.select("a", "b").where("a <> b")
    both = table(pairs.union(pairs.select("b", "a")).distinct(), "edges")
    if both.isEmpty():
        return both.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        before = labels.select("node", "label")
        near = both.join(before.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("_near"))
        step = before.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("label"))
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("_far"))
        after = table(step.join(jump, "label", "left").select("node", "_old", F.least("label", F.coalesce("_far", "label")).alias("label")), "labels")
        discard(labels)
        labels = after
        if not after.where("_old <> label").limit(1).count():
            discard(both)
            return after.select("node", "label")
