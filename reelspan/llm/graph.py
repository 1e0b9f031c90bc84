"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelspan.llm.common import beside, cut


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges(a, b), component being its smallest node.

    Labels take the smallest label beside them, then the label of their label (pointer jumping), so the
    rounds grow with the logarithm of the longest path.  Edges and labels stay distributed; each round is
    written to the shared folder, and only counts reach the driver.  Hot nodes: the minimum is pre-aggregated
    before its shuffle, and only labels that have a smaller one themselves are looked up, which are few.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = cut(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        up = step.filter("node <> label").join(step.select(F.col("label").alias("node")).distinct(), "node", "left_semi")
        up = up.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = cut(beside(step, up, "label", how="left").select("node", "old", F.coalesce("next", "label").alias("label")))
        labels = step.select("node", "label")
        if not step.filter("old <> label").limit(1).count():
            return labels.withColumnRenamed("label", "component")
