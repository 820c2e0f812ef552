"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dwspark.llm.tables import save


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``label`` for every node of an edge: the label is the smallest node it can reach.

    Each round points every node to its smallest neighbour (or itself), renames the edges by it and
    keeps the distinct ones that still join two nodes. Every node that is not a local minimum is gone
    after a round, so the rounds are few and each is smaller than the one before. A node with many
    edges is pre-aggregated on the map side. Rounds are written to the shared folder; nothing of them
    comes to the driver but whether edges are left.
    """
    edges = save(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        step = both.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("to"))
        step = save(step, "step")
        if labels is None:
            labels = save(step.withColumnRenamed("to", "label"), "labels")
        else:
            moved = labels.join(step.withColumnRenamed("node", "label"), "label", "left")
            labels = save(moved.select("node", F.coalesce("to", "label").alias("label")), "labels")
        left = edges.join(step.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a").join(
            step.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        edges = save(left.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).where("a < b").distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
