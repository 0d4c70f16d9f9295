"""Connected components of a graph given as edge rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``: the smallest node it reaches.

    Each round, a node takes the smallest label among its neighbours and then
    the label of that label, so distances about halve or better. Labels are
    written each round; hubs are combined before the shuffle.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("root")
    )
    labels = written(labels, "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy("a")
            .agg(F.min("root").alias("near"))
        )
        moved = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "root", F.least("root", "near").alias("to")
        )
        jump = labels.select(F.col("node").alias("to"), F.col("root").alias("far"))
        new = written(
            moved.join(jump, "to").select("node", F.least("to", "far").alias("new"), "root"), "labels"
        )
        labels = new.select("node", F.col("new").alias("root"))
        if new.filter("new < root").isEmpty():
            return labels
