"""Catalog and parquet table scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Full scan of a catalog table or view (one, two or three-part name)."""
    return spark.read.table(name)


def above_watermark(df: DataFrame, column: str, last_value) -> DataFrame:
    """Rows strictly above the stored watermark; with no stored value the whole table.

    The literal is cast to the column's own type, so the comparison reaches the parquet or
    JDBC scan as a pushed filter.
    """
    if last_value is None:
        return df
    dtype = df.schema[column].dataType
    return df.where(F.col(column) > F.lit(last_value).cast(dtype))


def scan_incremental(spark: SparkSession, name: str, column: str, last_value) -> DataFrame:
    return above_watermark(scan_table(spark, name), column, last_value)


def register_views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, views: dict[str, DataFrame] | None = None, args: dict | None = None) -> DataFrame:
    """Ad-hoc SQL over named frames, with bound (never concatenated) parameters.

    Frames are passed as `{name}` references that Spark resolves for this one statement, so no
    session-wide view is left behind.
    """
    return spark.sql(text, args=args, **(views or {}))


def utc_timestamp(column: str | Column) -> Column:
    """TIMESTAMP_NTZ to TIMESTAMP under a UTC session; watermarks need the latter."""
    col = F.col(column) if isinstance(column, str) else column
    return col.cast("timestamp")


def wall_clock(column: str | Column) -> Column:
    """TIMESTAMP back to TIMESTAMP_NTZ."""
    col = F.col(column) if isinstance(column, str) else column
    return col.cast("timestamp_ntz")
