"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wordloom.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label): every node of ``edges`` (a, b) with the smallest node it can reach.

    Labels fall to the smallest neighbour's label and then jump to the label of their
    label, until nothing changes; chains shorten by half per round. Every round is
    a written table, so a lost executor repeats one round at most.
    """
    both = stage(
        edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b"), F.col("a"))).distinct(), "links"
    )
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = stage(
            lower.join(jump, "label", "left").select("node", "was", F.least("label", F.coalesce("further", "label")).alias("label")),
            "labels",
        )
        changed = after.where("label <> was").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels
