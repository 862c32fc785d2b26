"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes of ``edges`` (a, b: long); the root is the least node of the component.

    Each round gives a node the least label near it and then the label of that
    label, so rounds grow with the logarithm of the longest path. Every round is a
    written table: a lost executor costs one round at most.
    """
    both = materialize(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("to"))
        jump = labels.select(F.col("node").alias("at"), F.col("root").alias("next"))
        new = materialize(step.join(jump, F.col("to") == F.col("at"), "left").select("node", F.least("to", "next").alias("root"), (F.least("to", "next") != F.col("root")).alias("moved")), "labels")
        labels = new.select("node", "root")
        if new.where("moved").isEmpty():
            return labels
