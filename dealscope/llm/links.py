"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealscope.llm.tables import kept, settled


@settled
def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component``, the smallest node it can reach, for every node of an edge.

    Each round hangs every node below its smallest neighbour, follows one more
    step, and draws the edges between the nodes they now hang from. Nodes with a
    smaller neighbour disappear, so rounds grow with the logarithm of the longest
    path. Only edge and label tables are shuffled; a hub is one row per task after
    the partial minimum.
    """
    edges = kept(edges.select(F.least(left, right).alias("u"), F.greatest(left, right).alias("v"))
                 .where("u < v").distinct(), "edges")
    labels = None
    while True:
        both = edges.select(F.col("u").alias("node"), F.col("v").alias("other")).union(edges.select("v", "u"))
        step = both.groupBy("node").agg(F.min("other").alias("other")).select(
            "node", F.least("node", "other").alias("parent"))
        step = kept(step, "parents")
        onward = step.select(F.col("node").alias("parent"), F.col("parent").alias("onward"))
        step = step.join(onward, "parent").select("node", F.col("onward").alias("parent"))
        if labels is None:
            labels = step.select("node", F.col("parent").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), F.col("parent").alias("moved"))
            labels = labels.join(moved, "component", "left").select(
                "node", F.coalesce("moved", "component").alias("component"))
        labels = kept(labels, "labels")
        ends = {end: step.select(F.col("node").alias(end), F.col("parent").alias(f"{end}_up")) for end in ("u", "v")}
        edges = kept(edges.join(ends["u"], "u").join(ends["v"], "v").select(
            F.least("u_up", "v_up").alias("u"), F.greatest("u_up", "v_up").alias("v")).where("u < v").distinct(),
            "edges")
        if edges.isEmpty():
            return labels
