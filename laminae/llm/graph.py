"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminae.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node with an edge (columns a, b: comparable ids); root is the smallest
    node of its component.

    Each round gives every node the smallest of itself and its neighbours, follows these labels to their ends,
    replaces both ends of all edges by theirs and drops loops and repeats. Following doubles its
    reach each time, so that a sorted path of n nodes is one round of log n steps; every round at least
    halves the nodes that still have edges. What is found is written to the shared folder. No step gathers a
    node's neighbours: minima are combined before the shuffle, and joins on a node with very many
    edges are ones that Spark splits."""
    edges = cut_lineage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("low"))
        low = ends(low)
        moved = (
            edges.join(low.select(F.col("node").alias("a"), F.col("low").alias("la")), "a")
            .join(low.select(F.col("node").alias("b"), F.col("low").alias("lb")), "b")
            .filter("la <> lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
            .distinct()
        )
        rounds.append(low)
        edges = cut_lineage(moved, "edges")
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds.pop()
    while rounds:
        step = rounds.pop()
        later = found.select(F.col("node").alias("low"), F.col("low").alias("further"))
        found = step.join(later, "low", "left").select("node", F.coalesce("further", "low").alias("low"))
        found = cut_lineage(found, "labels")
    return found.select("node", F.col("low").alias("root"))


def ends(labels: DataFrame) -> DataFrame:
    """node and low of a forest of labels (node, low; a root has its own), with every low followed to its root. Only
    nodes whose label is no root yet are joined again."""
    reached = cut_lineage(labels, "labels")
    while True:
        onward = reached.filter("node <> low").select(F.col("node").alias("low"), F.col("low").alias("further"))
        step = reached.join(onward, "low", "left").select("node", F.coalesce("further", "low").alias("low"), F.col("further").isNotNull().alias("moved"))
        step = cut_lineage(step, "labels")
        reached = step.select("node", "low")
        if step.filter("moved").isEmpty():
            return reached
