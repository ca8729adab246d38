"""Change feed between two versions of a table, and aggregates refreshed from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminae.operators.ordered import same_keys

# Change types of the feed.
CHANGE_TYPES = ["insert", "delete", "update_preimage", "update_postimage"]


def table_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Row-level changes with `_change_type`; an update yields its pre- and post-image."""
    columns = new.columns
    values = [c for c in columns if c not in keys]
    a, b = old.withColumn("_in", F.lit(True)).alias("a"), new.withColumn("_in", F.lit(True)).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in values], F.lit(True))
    had, has = F.col("a._in").isNotNull(), F.col("b._in").isNotNull()

    def image(side: str, kind: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns], kind.alias("_change_type"))

    before = F.when(had & (~has | ~same), image("a", F.when(has, "update_preimage").otherwise("delete")))
    after = F.when(has & (~had | ~same), image("b", F.when(had, "update_postimage").otherwise("insert")))
    return a.join(b, same_keys("a", "b", keys), "full_outer").select(
        F.inline(F.array_compact(F.array(before, after)))
    )


def refresh_sums(aggregate: DataFrame, changes: DataFrame, groups: list[str], sums: dict[str, Column], count: str) -> DataFrame:
    """Count and sum aggregates moved forward by signed deltas; emptied groups disappear."""
    sign = F.when(F.col("_change_type").isin("insert", "update_postimage"), 1).otherwise(-1)
    delta = changes.groupBy(*groups).agg(
        F.sum(sign).cast("long").alias(count),
        *[F.sum(value * sign).cast(aggregate.schema[name].dataType).alias(name) for name, value in sums.items()],
    )
    merged = aggregate.select(*groups, count, *sums).unionByName(delta).groupBy(*groups).agg(
        F.sum(count).cast("long").alias(count),
        *[F.sum(name).cast(aggregate.schema[name].dataType).alias(name) for name in sums],
    )
    return merged.where(F.col(count) > 0)


def refresh_groups(
    aggregate: DataFrame, changes: DataFrame, table: DataFrame, groups: list[str], aggs: list[Column]
) -> DataFrame:
    """Any aggregate: recompute the groups that changed, keep the others as stored."""
    touched = changes.select(*groups).distinct().alias("t")
    kept = aggregate.alias("g").join(touched, same_keys("g", "t", groups), "left_anti")
    redone = table.alias("s").join(touched, same_keys("s", "t", groups), "left_semi").groupBy(*groups).agg(*aggs)
    return kept.unionByName(redone)
