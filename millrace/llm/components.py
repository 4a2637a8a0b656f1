"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that edges (a, b) touch; a component is its smallest node.

    Every round takes the smallest label among a node's neighbours, then the label of that label,
    until nothing changes. A round is written, so a lost executor costs one round. Nodes and edges
    stay in Spark; one count a round reaches the driver.
    """
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .filter("a <> b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("other")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("other").alias("other")))
        stepped = labels.join(near, "node").select(
            "node", F.col("component").alias("before"), F.least("component", "other").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("component").alias("further"))
        after = written(stepped.join(jump, "label").select(
            "node", "before", F.least("label", "further").alias("component")), "labels")
        if after.filter("component < before").isEmpty():
            return after.select("node", "component")
        labels = after.select("node", "component")
