"""Control state: watermarks, batch versions and append-only logs.

State is small (a row per table). Every change is a new row appended to a log; the current value
is the newest row per table. Appends never rewrite what other runs read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from laminae.operators.scd import latest_per_key
from laminae.sources.tables import above_watermark

# The control tables and their columns.
CONTROL_TABLES = {
    "watermarks": "table_name string, watermark_column string, watermark_value string, row_count bigint, updated_at timestamp",
    "batch_state": "table_name string, batch_id bigint, batch_timestamp timestamp, updated_at timestamp",
    "reconciliation_log": "table_name string, reconciliation_ts timestamp, method string, status string, details string",
    "source_metadata": "table_name string, source_schema string, source_table string, schema_hash string, schema_json string, updated_at timestamp",
}


@dataclass
class Control:
    spark: SparkSession
    base: str

    def _path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def log(self, name: str) -> DataFrame:
        """Every row ever appended; empty when the table was never written."""
        try:
            return self.spark.read.schema(CONTROL_TABLES[name]).parquet(self._path(name))
        except AnalysisException:
            return self.spark.createDataFrame([], CONTROL_TABLES[name])

    def append(self, name: str, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, CONTROL_TABLES[name]).coalesce(1).write.mode("append").parquet(self._path(name))

    def current(self, name: str) -> DataFrame:
        order = ["batch_id", "updated_at"] if name == "batch_state" else ["updated_at"]
        return latest_per_key(self.log(name), ["table_name"], order)

    def watermark(self, table: str):
        row = self.current("watermarks").where(F.col("table_name") == table).head()
        return row.watermark_value if row else None

    def set_watermark(self, table: str, column: str, value, rows: int, at) -> None:
        self.append("watermarks", [(table, column, str(value), int(rows), at)])

    def next_batch(self, table: str, at) -> int:
        """Monotonic version number, used as the sequence of snapshot loads."""
        row = self.log("batch_state").where(F.col("table_name") == table).agg(F.max("batch_id").alias("m")).head()
        number = int(row.m or 0) + 1
        self.append("batch_state", [(table, number, at, at)])
        return number


def increment(source: DataFrame, column: str, last_value) -> tuple[DataFrame, DataFrame]:
    """(new rows, one row with their highest watermark value and count)."""
    fresh = above_watermark(source, column, last_value)
    return fresh, fresh.agg(F.max(column).alias("watermark_value"), F.count(F.lit(1)).alias("row_count"))


def incremental_load(control: Control, table: str, source: DataFrame, column: str, target: str, at) -> int:
    """Read above the stored watermark, append, then advance it. Returns the rows loaded.

    The batch is written under its own number first and measured from what was written, so source
    rows arriving meanwhile are neither lost nor counted. A run that died before advancing the
    watermark wrote a folder whose number was never confirmed; the rerun overwrites it.
    """
    state = control.watermark(table)
    fresh = above_watermark(source, column, state)
    done = control.log("watermarks").where(F.col("table_name") == table).count()
    folder = f"{target.rstrip('/')}/_batch_id={done + 1}"
    fresh.write.mode("overwrite").parquet(folder)
    written = control.spark.read.schema(source.schema).parquet(folder)
    top = written.agg(F.max(column).alias("hi"), F.count(F.lit(1)).alias("n")).head()
    if top.n:
        control.set_watermark(table, column, top.hi, top.n, at)
    return top.n
