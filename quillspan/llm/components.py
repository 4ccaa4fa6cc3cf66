"""Connected components by least labels and pointer jumping, on settled tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, settle


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node with an edge: the label is the least node of its component.

    Each round takes the least label among a node and its neighbours (partial minima before the
    shuffle, so a node of any degree is fine) and then the label of that label; rounds are about the
    logarithm of the longest path. Every round is written and reread, which cuts the lineage.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node != other")
    both = settle(both.union(both.select("other", "node")).distinct(), "cc-edges")
    labels = settle(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("label")), "cc-labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("seen")), "other").groupBy("node").agg(F.min("seen").alias("seen"))
        low = settle(labels.join(seen, "node").select("node", F.least("label", "seen").alias("low"), "label"), "cc-low")
        jump = low.select(F.col("node").alias("low"), F.col("low").alias("next"))
        new = settle(low.join(jump, "low", "left").select("node", F.coalesce("next", "low").alias("label"), (F.coalesce("next", "low") != F.col("label")).alias("moved")), "cc-labels")
        moved = new.filter("moved").limit(1).count()
        discard(low, labels)
        labels = new
        if not moved:
            discard(both)
            return new.select("node", "label")
