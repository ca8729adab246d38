"""Keep a relational copy of a table in step: whole copy, or only what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminae.operators.changes import table_changes
from laminae.sources.jdbc import JdbcSource

# Sync policies.
POLICIES = ["SNAPSHOT", "TRIGGERED", "CONTINUOUS"]


def copy_snapshot(df: DataFrame, target: JdbcSource, table: str, writers: int = 8) -> None:
    """Replace the target's rows. `writers` bounds the connections opened at once; the rows are
    shuffled to them, so the work before the write keeps its own parallelism."""
    (
        df.repartition(writers)
        .write.format("jdbc")
        .options(**target.option_map())
        .option("dbtable", table)
        .option("truncate", "true")
        .mode("overwrite")
        .save()
    )


def changes_to_apply(last_synced: DataFrame, current: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to upsert, keys to delete) since the version that was synced last."""
    feed = table_changes(last_synced, current, keys)
    upserts = feed.where(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
    return upserts, feed.where(F.col("_change_type") == "delete").select(*keys)


def stage_changes(last_synced: DataFrame, current: DataFrame, keys: list[str], target: JdbcSource, table: str) -> None:
    """Write the change set to `<table>_upserts` and `<table>_deletes`; the database merges them in
    one transaction of its own (Spark's JDBC writer only appends or replaces)."""
    upserts, deletes = changes_to_apply(last_synced, current, keys)
    copy_snapshot(upserts, target, f"{table}_upserts")
    copy_snapshot(deletes, target, f"{table}_deletes")


def sync(
    current: DataFrame,
    keys: list[str],
    target: JdbcSource,
    table: str,
    policy: str = "SNAPSHOT",
    last_synced: DataFrame | None = None,
) -> None:
    if policy not in POLICIES:
        raise ValueError(f"unknown sync policy {policy!r}")
    if policy == "SNAPSHOT" or last_synced is None:
        copy_snapshot(current, target, table)
    else:
        stage_changes(last_synced, current, keys, target, table)


def sync_stream(stream: DataFrame, target: JdbcSource, table: str, checkpoint: str, policy: str = "TRIGGERED", interval: str = "60 seconds"):
    """Append a stream to the target: TRIGGERED drains what is there, CONTINUOUS keeps going.

    Delivery is at least once: a batch repeated after a failure carries the same `_batch_id`, by
    which the receiver recognises it.
    """
    if policy not in POLICIES[1:]:
        raise ValueError(f"a stream syncs TRIGGERED or CONTINUOUS, not {policy!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch_id", F.lit(batch_id)).repartition(8).write.format("jdbc").options(
            **target.option_map()
        ).option("dbtable", table).mode("append").save()

    trigger = {"availableNow": True} if policy == "TRIGGERED" else {"processingTime": interval}
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()
