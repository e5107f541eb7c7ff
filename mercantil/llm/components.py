"""Connected components of an edge table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercantil.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (a, b: long); the label is the smallest node.

    Each round takes the smallest label among a node's neighbours and then the label of
    that label, so the number of rounds is about the logarithm of the longest shortest
    path. Labels are written between rounds. Only one count a round reaches the driver.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .filter("a <> b").distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("_m"))
                    .select(F.col("a").alias("node"), F.least("a", "_m").alias("label")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("_n")))
        least = labels.join(near, labels.node == near.a).select(
            "node", F.col("label").alias("_old"), F.least("label", "_n").alias("_new"))
        over = labels.select(F.col("node").alias("_node"), F.col("label").alias("_next"))
        new = stored(least.join(over, F.col("_new") == F.col("_node"), "left").select(
            "node", "_old", F.least("_new", "_next").alias("label")), "labels")
        labels = new.select("node", "label")
        if not new.filter("label < _old").limit(1).count():
            return labels
