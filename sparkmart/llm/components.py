"""Connected components of a graph given by its edges, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.runtime import materialize


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of an edge (a, b); root is the smallest node of its component.

    Each round takes the smallest label among a node's neighbours (combined before the shuffle, so a node with many
    edges is no hot key) and then follows labels of labels. Rounds end when nothing has changed; each is written to the
    checkpoint folder, which keeps the plan short and outlives lost executors. Nodes are numbers; loops and repeated
    edges do no harm; edges with a null end are ignored.
    """
    edges = edges.select("a", "b").dropna()
    both = materialize(edges.union(edges.select("b", "a")).where("a != b").distinct(), f"{label}-edges")
    state = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).select(F.col("a").alias("node"), "root"), label)
    while True:
        seen = both.join(state, both.b == state.node).groupBy("a").agg(F.min("root").alias("near"))
        lower = state.join(seen, state.node == seen.a).select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        up = state.select(F.col("node").alias("at"), F.col("root").alias("above"))
        jumped = lower.join(up, lower.root == up["at"]).select("node", "old", F.least("root", "above").alias("root"))
        state = materialize(jumped, label)
        if state.where("old != root").isEmpty():
            return state.select("node", "root")
        state = state.select("node", "root")
