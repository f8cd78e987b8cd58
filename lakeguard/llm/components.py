"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeguard.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (a, b: long); the label is the component's smallest node.

    A round takes the smallest label among a node's neighbours (pre-aggregated
    per task) and then the label of that label, so stars and chains fold at once.
    Rounds go on until no label moves; each is written to the shared folder.
    """
    both = materialise(edges.where("a != b").select("a", "b").union(edges.where("a != b").select("b", "a")).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label"))
    labels = materialise(labels, "labels")
    while True:
        near = labels.select(F.col("node").alias("b"), F.col("label").alias("other"))
        heard = both.join(near, "b").groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other"))
        moved = labels.join(heard, "node").select("node", F.col("label").alias("old"), F.least("label", "other").alias("label"))
        moved = materialise(moved, "moved")
        jump = moved.select(F.col("node").alias("label"), F.col("label").alias("root"))
        labels = materialise(moved.join(jump, "label").select("node", F.col("root").alias("label"), "old"), "labels")
        if labels.where("label != old").isEmpty():
            return labels.select("node", "label")
