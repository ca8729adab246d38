"""Whole-table versions as `v=N` folders of parquet.

A version counts once its write has committed (`_SUCCESS`), so a run that dies half-way leaves the
former version current. Readers pick the newest committed number.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def committed(spark: SparkSession, path: str, prefix: str = "v=") -> list[str]:
    """Values of the `prefix` folders below a path that hold a finished write, from the listing
    alone: no data file is opened."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    values = []
    for status in fs.listStatus(hadoop):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(prefix) and fs.exists(done):
            values.append(name[len(prefix) :])
    return values


def _folders(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(v) for v in committed(spark, path))


def latest_version(spark: SparkSession, path: str) -> int:
    return max(_folders(spark, path), default=0)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    number = version or latest_version(spark, path)
    return spark.read.parquet(f"{path}/v={number}") if number else None


def write_version(df: DataFrame, path: str, version: int | None = None) -> int:
    number = version or latest_version(df.sparkSession, path) + 1
    df.write.mode("overwrite").parquet(f"{path}/v={number}")
    return number


def drop_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_version(spark: SparkSession, path: str, version: int) -> None:
    drop_folder(spark, f"{path}/v={version}")


def drop_versions(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Retention: delete all but the newest `keep` committed versions."""
    old = _folders(spark, path)[:-keep] if keep else []
    for number in old:
        drop_version(spark, path, number)
    return old


AUDIT_PREFIX = "_snapshot="


def append_audit(df: DataFrame, path: str, batch_id: int, taken_on, partition_by: str | None = None) -> None:
    """Raw copy of a snapshot in a folder named by its date and number; writing a batch again
    replaces it. Readers see the name as column `_snapshot`."""
    writer = df.withColumn("_batch_id", F.lit(batch_id)).write.mode("overwrite")
    target = f"{path}/{AUDIT_PREFIX}{taken_on}.{batch_id}"
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(target)


def expire_audit(spark: SparkSession, path: str, as_of, retention_days: int) -> list[int]:
    """Drop audit copies older than the retention, judged by folder name; returns their numbers."""
    oldest = date.fromisoformat(str(as_of)) - timedelta(days=retention_days)
    gone = []
    for name in committed(spark, path, AUDIT_PREFIX):
        taken_on, number = name.split(".")
        if date.fromisoformat(taken_on) < oldest:
            drop_folder(spark, f"{path}/{AUDIT_PREFIX}{name}")
            gone.append(int(number))
    return sorted(gone)
