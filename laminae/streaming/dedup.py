"""Duplicate removal with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laminae.streaming.basics import event_time


def by_key(df: DataFrame, keys: list[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """First row per key. A stream remembers keys for the watermark delay; a batch ranks rows, and
    `row_number() = 1` keeps one row per key in each map task before the shuffle."""
    if df.isStreaming:
        return event_time(df, ts, delay).dropDuplicatesWithinWatermark(keys)
    rest = [c for c in df.columns if c not in keys and c != ts]
    first = W.partitionBy(*keys).orderBy(ts, *rest)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def in_window(df: DataFrame, columns: list[str], ts: str, arrived: str, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Equal rows within a time window collapse to one, with the earliest arrival."""
    return (
        event_time(df, ts, delay)
        .groupBy(*columns, ts, F.window(ts, window))
        .agg(F.min(arrived).alias("first_seen_at"))
        .drop("window")
    )


def composite(df: DataFrame, columns: list[str], ts: str, arrived: str, delay: str = "1 hour") -> DataFrame:
    """Rows equal in all listed columns and event time collapse to one."""
    return event_time(df, ts, delay).groupBy(*columns, ts).agg(F.min(arrived).alias(arrived))
