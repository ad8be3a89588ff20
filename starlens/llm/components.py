"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlens.session import stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of (a, b): the smallest node that it is connected to.

    Each round takes the smallest label among the neighbours and then that node's own label, so paths shorten by
    half and more; rounds are staged and end when no label changes.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), f"{name}-edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), f"{name}-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("far"))
        after = stage(lower.join(jump, "to", "left").select("node", "old", F.least("to", F.coalesce("far", "to")).alias("component")), f"{name}-labels")
        labels = after.select("node", "component")
        if after.where("component <> old").isEmpty():
            return labels
