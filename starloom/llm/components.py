"""Connected components of a graph given by its edges, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import pin, unpin


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a < b, that connect the same nodes with about one edge a node: each node keeps
    the edge to its smallest neighbour below it, and its other neighbours below are tied to that
    one. In dense groups most of these ties are equal and become one. A node gathers its neighbours
    below it: callers tie the members of a group to the smallest, so these are few."""
    up = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    least = F.min("a").over(Window.partitionBy("b"))
    tied = up.select("a", "b", least.alias("least")).select(
        "least", F.when(F.col("a") == F.col("least"), F.col("b")).otherwise(F.col("a")).alias("other"))
    return tied.select(F.col("least").alias("a"), F.col("other").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of ``edges`` (a, b): the smallest node of its component.

    Each round takes the smallest label among the neighbours and then the label of that label,
    so labels travel twice as far each time; rounds go on until nothing changes. Edges are
    contracted first, so that every join has about as many rows as there are nodes. Tables between rounds are written in the shared
    folder and deleted when the next is there. No edges give no rows."""
    up = pin(contracted(edges), "contracted")
    both = pin(up.select("a", "b").union(up.select("b", "a")), "edges")
    unpin(up)
    labels = pin(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("at"), F.col("label").alias("next"))
        after = pin(hooked.join(jump, F.col("label") == F.col("at")).select(
            "node", F.least("label", "next").alias("label"), "old"), "labels")
        done = after.where("label <> old").isEmpty()
        unpin(labels)
        labels = after.select("node", "label")
        if done:
            unpin(both)
            return labels
