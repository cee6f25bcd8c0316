"""Connected components by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of the nodes of ``edges(a, b)``: the smallest node each can reach.

    Each round takes the least label among a node's neighbours and then the label of
    that label, so labels travel twice as far every round. A round is written down
    before the next, so lineage stays short and a lost executor costs one round.
    Neighbours are met by an equality join, which adaptive execution splits at hubs, and
    reduced by partial aggregation, so no node's neighbours are ever gathered.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        step = lower.join(jump, "mid").select("node", F.least("mid", "far").alias("label"), "old")
        new = written(step.withColumn("moved", F.col("label") < F.col("old")).drop("old"))
        labels = new.drop("moved")
        if new.where("moved").limit(1).count() == 0:
            return labels
