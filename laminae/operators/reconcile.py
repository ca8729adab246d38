"""Comparing a source with the state kept for it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminae.functions.audit import instant
from laminae.operators.ordered import same_keys
from laminae.session import cut_lineage

# Reconciliation methods.
METHODS = ["rowcount", "key_hash", "full_snapshot"]


def rowcount(source: DataFrame, state: DataFrame, table: str) -> DataFrame:
    n = lambda df, side: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")
    both = n(source, "source").unionByName(n(state, "state"))
    pick = lambda side: F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0))
    return both.agg(pick("source").alias("source_rows"), pick("state").alias("state_rows")).select(
        F.lit(table).alias("table_name"),
        "source_rows",
        "state_rows",
        (F.col("source_rows") - F.col("state_rows")).alias("difference"),
        F.when(F.col("source_rows") == F.col("state_rows"), "match").otherwise("mismatch").alias("status"),
    )


def bucket_sums(df: DataFrame, keys: list[str], columns: list[str], buckets: int) -> DataFrame:
    """Row count and order-free hash sum per key bucket: one map-side aggregate, `buckets` rows out."""
    return df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h"),
    )


def full_compare(source: DataFrame, state: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Keys that are missing from the state, extra in it, or changed (null-safe)."""
    values = [c for c in (columns or source.columns) if c not in keys]
    a = source.select(*keys, *values).withColumn("_in", F.lit(True)).alias("a")
    b = state.select(*keys, *values).withColumn("_in", F.lit(True)).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in values], F.lit(True))
    outcome = (
        F.when(F.col("b._in").isNull(), "missing")
        .when(F.col("a._in").isNull(), "extra")
        .when(~same, "changed")
    )
    return (
        a.join(b, same_keys("a", "b", keys), "full_outer")
        .select(
            *[F.when(F.col("a._in").isNotNull(), F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in keys],
            outcome.alias("outcome"),
        )
        .where(F.col("outcome").isNotNull())
    )


def key_hash(
    source: DataFrame, state: DataFrame, keys: list[str], columns: list[str] | None = None, buckets: int = 4096
) -> DataFrame:
    """Same result as `full_compare`, but only rows of buckets whose sums differ are joined."""
    cols = columns or source.columns
    s, t = bucket_sums(source, keys, cols, buckets).alias("s"), bucket_sums(state, keys, cols, buckets).alias("t")
    differing = s.join(t, F.col("s.bucket") == F.col("t.bucket"), "full_outer").where(
        ~F.col("s.n").eqNullSafe(F.col("t.n")) | ~F.col("s.h").eqNullSafe(F.col("t.h"))
    ).select(F.coalesce("s.bucket", "t.bucket").alias("_bucket"))
    differing = cut_lineage(differing, "buckets")  # at most `buckets` rows, found once for both sides

    def suspects(df: DataFrame) -> DataFrame:
        bucketed = df.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
        return bucketed.join(differing, "_bucket", "left_semi").drop("_bucket")

    return full_compare(suspects(source), suspects(state), keys, cols)


def log_rows(outcomes: DataFrame, table: str, method: str, at) -> DataFrame:
    """One log row per reconciliation, from the outcome counts."""
    n = lambda kind: F.coalesce(F.sum(F.when(F.col("outcome") == kind, 1)), F.lit(0))
    return outcomes.agg(n("missing").alias("m"), n("extra").alias("e"), n("changed").alias("c")).select(
        F.lit(table).alias("table_name"),
        instant(at).alias("reconciliation_ts"),
        F.lit(method).alias("method"),
        F.when(F.col("m") + F.col("e") + F.col("c") == 0, "match").otherwise("mismatch").alias("status"),
        F.format_string("missing=%d extra=%d changed=%d", "m", "e", "c").alias("details"),
    )
