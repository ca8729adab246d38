"""Quality monitors: profile metrics per refresh, per time window, and for prediction logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laminae.operators.profile import profile


def snapshot(df: DataFrame, table: str, refresh_id: int, approx: bool = True) -> DataFrame:
    """One refresh: the table's profile stamped with the refresh number."""
    return profile(df, approx=approx).select(F.lit(table).alias("table_name"), F.lit(refresh_id).alias("refresh_id"), "*")


def time_series(df: DataFrame, ts: str, granularities: list[str] | None = None, approx: bool = True) -> DataFrame:
    """Profile metrics per window, for every granularity (default one day)."""

    def one(grain: str) -> DataFrame:
        start = F.window(F.col(ts), grain).start.alias("_w")
        rows = df.select(*[c for c in df.columns if c != ts], start)
        return profile(rows, groups=[F.col("_w").alias("window_start")], approx=approx).select(
            F.lit(grain).alias("granularity"), "*"
        )

    return reduce(DataFrame.unionByName, [one(g) for g in granularities or ["1 day"]])


def inference(df: DataFrame, ts: str, prediction: str, label: str, granularity: str = "1 day") -> DataFrame:
    """Confusion counts and accuracy of a prediction log by window."""
    w = F.window(F.col(ts), granularity).start.alias("window_start")
    return df.groupBy(w).agg(
        F.count(F.lit(1)).alias("predictions"),
        F.sum(F.when(F.col(prediction) == F.col(label), 1).otherwise(0)).alias("correct"),
        F.sum(F.when((F.col(prediction) == 1) & (F.col(label) == 1), 1).otherwise(0)).alias("true_positive"),
        F.sum(F.when((F.col(prediction) == 1) & (F.col(label) == 0), 1).otherwise(0)).alias("false_positive"),
        F.sum(F.when((F.col(prediction) == 0) & (F.col(label) == 1), 1).otherwise(0)).alias("false_negative"),
        F.sum(F.when((F.col(prediction) == 0) & (F.col(label) == 0), 1).otherwise(0)).alias("true_negative"),
        F.round(F.avg(F.when(F.col(prediction) == F.col(label), 1.0).otherwise(0.0)), 6).alias("accuracy"),
    )


def refresh_history(metrics: DataFrame) -> DataFrame:
    """Change of null rate, mean and distinct count between consecutive refreshes of a column."""
    by_column = W.partitionBy("table_name", "column_name").orderBy("refresh_id")
    null_rate = F.col("null_count") / F.col("total_count")
    delta = lambda c: c - F.lag(c).over(by_column)
    out = metrics.select(
        "table_name",
        "column_name",
        "refresh_id",
        "total_count",
        delta(F.col("total_count")).alias("row_change"),
        F.round(delta(null_rate), 6).alias("null_rate_change"),
        F.round(delta(F.col("mean_value")), 6).alias("mean_change"),
        *([delta(F.col("unique_count")).alias("unique_change")] if "unique_count" in metrics.columns else []),
    )
    return out
