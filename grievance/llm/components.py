"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grievance.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``id, component`` of every end of the links ``a, b``: the smallest id that can be reached.

    Each round hands the smallest label seen by a node or its neighbours to
    the node and to the node its old label names, so chains halve; labels are
    combined before the shuffle, and every round is written to the shared folder.
    """
    edges = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = staged(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"), "labels")
    while True:
        told = edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("told"))
        near = labels.join(told.withColumnRenamed("a", "id"), "id").select("id", "label", F.least("label", "told").alias("least"))
        near = staged(near, "near")
        # What a node learns also goes to the node of its old label.
        up = near.groupBy("label").agg(F.min("least").alias("up")).withColumnRenamed("label", "id")
        best = near.join(up, "id", "left").select("id", "label", F.least("least", F.coalesce("up", "least")).alias("best"))
        # Pointer jump: the label of the label.
        jump = best.select(F.col("id").alias("best"), F.col("best").alias("jump"))
        moved = staged(best.join(jump, "best", "left").select("id", "label", F.least("best", F.coalesce("jump", "best")).alias("new")), "moved")
        done = moved.filter(F.col("new") != F.col("label")).isEmpty()
        labels = moved.select("id", F.col("new").alias("label"))
        if done:
            return labels.withColumnRenamed("label", "component")
