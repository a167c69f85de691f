"""Connected components of links by distributed label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gable.runtime import written


def components(links: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) for every node of links (a, b).

    Each round takes the smallest label of the neighbours and then the label of that label; labels are written once per
    round, so the lineage stays short. Only the number of changes reaches the driver.
    """
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("label")))
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("low"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "low").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        moved = written(lower.join(jump, "via").select("node", F.least("via", "far").alias("label"), "old"))
        labels = moved.select("node", "label")
        if moved.where("label <> old").isEmpty():
            return labels
