"""Connected components of a large graph, as rounds of joins.

In each round every node takes the smallest label among its own and its
neighbours', and then the label of that label, so that chains shorten by half.
Each round is stored; the number of labels that still move is all the driver sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.session import materialize


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for all nodes of ``edges`` (columns a, b); a component is named by its smallest node."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.filter("a <> b").distinct(), f"{label}-edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("component")), f"{label}-0")
    moved, turn = True, 0
    while moved:
        turn += 1
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("component").alias("near"))
        closer = labels.join(near, "node", "left").select(
            "node", F.col("component").alias("before"),
            F.least("component", F.coalesce("near", "component")).alias("component"))
        closer = materialize(closer, f"{label}-{turn}-near")
        roots = closer.select(F.col("node").alias("component"), F.col("component").alias("root"))
        stepped = materialize(closer.join(roots, "component", "left").select(
            "node", "before", F.coalesce("root", "component").alias("component")), f"{label}-{turn}")
        moved = not stepped.filter("before <> component").isEmpty()
        labels = stepped.select("node", "component")
    return labels
