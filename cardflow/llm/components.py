"""Connected components of a graph given as pairs, by least labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardflow.llm.tables import Scratch


def components(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label (least node reachable) for every node of `pairs` (columns a, b).

    A round takes the least label among neighbours, then the label's label. Minima are combined
    before they are moved, and a node with very many neighbours is a skewed join key, which adaptive
    execution splits. Each round is a table of `scratch`."""
    edges = scratch.saved(pairs.select("a", "b").union(pairs.select("b", "a")).distinct(), "edges")
    labels = scratch.saved(
        edges.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label")),
        "labels",
    )
    while True:
        near = (
            edges.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("near"))
            .withColumnRenamed("a", "node")
        )
        step = labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        following = scratch.saved(
            step.join(up, "label").select("node", F.least("label", "top").alias("label"), "was"), "labels"
        )
        if following.where(F.col("label") != F.col("was")).isEmpty():
            return following.select("node", "label")
        labels = following.select("node", "label")
