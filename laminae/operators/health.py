"""Health checks: stale watermarks, layer volumes, freshness and threshold alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Comparison operators of an alert.
COMPARISONS = {
    "EQUAL": lambda a, b: a == b,
    "NOT_EQUAL": lambda a, b: a != b,
    "GREATER_THAN": lambda a, b: a > b,
    "GREATER_THAN_OR_EQUAL": lambda a, b: a >= b,
    "LESS_THAN": lambda a, b: a < b,
    "LESS_THAN_OR_EQUAL": lambda a, b: a <= b,
}


def stale_watermarks(watermarks: DataFrame, as_of: Column, hours: int = 24, column: str = "updated_at") -> DataFrame:
    return watermarks.where(F.col(column) < as_of - F.expr(f"INTERVAL {int(hours)} HOURS"))


def layer_row_counts(frames: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table, rows); each count is answered from file footers where the format allows."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "row_count"
        )
        for (layer, table), df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def freshness(frames: dict[str, tuple[DataFrame, str]], as_of: Column) -> DataFrame:
    """Newest event and lag in whole minutes for each table."""
    parts = [
        df.agg(F.max(column).cast("timestamp_ntz").alias("latest_event")).select(
            F.lit(name).alias("table_name"),
            "latest_event",
            F.timestamp_diff("MINUTE", F.col("latest_event"), as_of).alias("lag_minutes"),
        )
        for name, (df, column) in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def alert(value: DataFrame, name: str, operator: str, threshold, notify_on_ok: bool = False) -> DataFrame:
    """`value` is a one-row, one-column frame. NULL (no data) is reported as UNKNOWN."""
    if operator not in COMPARISONS:
        raise ValueError(f"unknown comparison {operator!r}")
    v = F.col(value.columns[0])
    fired = COMPARISONS[operator](v, F.lit(threshold))
    state = F.when(v.isNull(), "UNKNOWN").when(fired, "TRIGGERED").otherwise("OK")
    out = value.select(F.lit(name).alias("alert"), v.cast("double").alias("value"), state.alias("state"))
    return out.withColumn("notify", (F.col("state") == "TRIGGERED") | ((F.col("state") == "OK") & F.lit(notify_on_ok)))
