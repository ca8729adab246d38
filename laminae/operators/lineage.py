"""Lineage over an edge table (source, target, event time)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminae.session import cut_lineage


def neighbours(edges: DataFrame, match: str, wanted: str, node: str, time: str = "event_time") -> DataFrame:
    """Distinct nodes on the other end of a node's edges, with the newest edge time."""
    return edges.where(F.col(match) == node).groupBy(wanted).agg(F.max(time).alias("last_updated"))


def closure(edges: DataFrame, start: str | Column, source: str, target: str, max_depth: int = 10) -> DataFrame:
    """All edges upstream of `start` with the depths at which they are reached, to `max_depth`.

    A frontier loop: each level reads the edges once and keeps those that lead into the distinct
    frontier nodes, so only matched edges are made distinct and paths are never enumerated. Levels
    are written to the shared folder, which keeps plans short and survives lost executors.
    """
    pairs = edges.select(F.col(source).alias("_s"), F.col(target).alias("_t"))
    level = cut_lineage(pairs.where(F.col("_t") == start).distinct().withColumn("depth", F.lit(1)), "closure")
    found = level
    for depth in range(2, max_depth + 1):
        frontier = level.select(F.col("_s").alias("_n")).distinct()
        reached = pairs.join(frontier, F.col("_t") == F.col("_n"), "left_semi").distinct()
        level = cut_lineage(reached.withColumn("depth", F.lit(depth)), "closure")
        if level.isEmpty():
            break
        found = found.unionByName(level)
    return found.select(F.col("_s").alias(source), F.col("_t").alias(target), "depth")


def fan_in(edges: DataFrame, source: str, target: str, k: int = 20) -> DataFrame:
    """Targets by number of distinct sources."""
    counted = edges.groupBy(target).agg(F.countDistinct(source).alias("upstream_count"))
    return counted.orderBy(F.col("upstream_count").desc(), F.col(target)).limit(k)
