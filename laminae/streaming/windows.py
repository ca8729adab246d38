"""Event-time aggregates. Each function accepts a stream or a batch frame and gives the same columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminae.streaming.basics import event_time


def tumbling(df: DataFrame, ts: str, size: str, keys: list[str], aggs: list[Column], delay: str = "10 minutes") -> DataFrame:
    grouped = event_time(df, ts, delay).groupBy(*keys, F.window(ts, size)).agg(*aggs)
    return grouped.withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")}).drop("window")


def multi(df: DataFrame, ts: str, sizes: dict[str, list[Column]], keys: list[str], delay: str = "10 minutes") -> dict[str, DataFrame]:
    """One frame per window size over the same source; each runs with its own checkpoint."""
    return {size: tumbling(df, ts, size, keys, aggs, delay) for size, aggs in sizes.items()}


def session(df: DataFrame, ts: str, keys: list[str], gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Sessions closed after `gap` of quiet: bounds and event count. The ordered steps of a session
    come from the batch operator as rows, so no session is held in one array."""
    grouped = event_time(df, ts, delay).groupBy(*keys, F.session_window(ts, gap).alias("session"))
    return grouped.agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("event_count")
    ).drop("session")


def daily(df: DataFrame, ts: str, aggs: list[Column], delay: str = "1 day") -> DataFrame:
    """By the day an event happened, whenever it arrived."""
    grouped = event_time(df, ts, delay).groupBy(F.window(ts, "1 day")).agg(*aggs)
    return grouped.withColumn("event_date", F.to_date("window.start")).drop("window")


def running_totals(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Totals per key since the beginning. State grows with the number of keys: run it with the
    RocksDB store in update mode, or bound it with `tumbling`."""
    return df.groupBy(*keys).agg(*aggs)


def lag_monitor(df: DataFrame, ts: str, source: str, as_of: Column, delay: str = "10 minutes") -> DataFrame:
    """Newest event per minute and its distance in seconds from `as_of`."""
    newest = event_time(df, ts, delay).groupBy(F.window(ts, "1 minute")).agg(F.max(ts).alias("max_event_timestamp"))
    lag = F.unix_timestamp(as_of.cast("timestamp")) - F.unix_timestamp("max_event_timestamp")
    return newest.select(F.lit(source).alias("source"), F.col("window.start").alias("window_start"), "max_event_timestamp", lag.alias("lag_seconds"))
