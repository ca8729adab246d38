"""Starting streams: event time, triggers, state store and exactly-once file output."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Fixed value: state store for large keyed state.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MODES = ["triggered", "continuous"]


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state outside the heap; changelog checkpoints upload only what changed."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def event_time(df: DataFrame, ts: str, delay: str | None = None) -> DataFrame:
    """A TIMESTAMP event-time column with a watermark. On a batch frame the watermark is inert."""
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, delay) if delay else df


def trigger_options(mode: str = "triggered", interval: str = "60 seconds") -> dict:
    """`triggered` drains what is there and stops; `continuous` keeps going at the interval."""
    if mode not in MODES:
        raise ValueError(f"unknown execution mode {mode!r}")
    return {"availableNow": True} if mode == "triggered" else {"processingTime": interval}


def append_files(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "triggered", interval: str = "60 seconds", fmt: str = "parquet"
) -> StreamingQuery:
    """Append with the file sink, whose commit log makes restarts exactly-once."""
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(mode, interval))
        .start()
    )


def write_batches(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "triggered", interval: str = "60 seconds", output_mode: str = "append"
) -> StreamingQuery:
    """Each micro-batch replaces its own `_batch_id` folder, so a repeated batch adds nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/_batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(mode, interval))
        .start()
    )


def fan_in(streams: list[DataFrame]) -> DataFrame:
    """Several sources into one stream."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def backfill_number(name: str) -> int:
    return -1 - crc32(name.encode())


def backfill_once(df: DataFrame, path: str, name: str) -> bool:
    """One-time batch load into a streamed target. The folder of the backfill is its marker: when
    it was committed before, nothing happens. Its number is negative, below those of all micro-batches."""
    spark = df.sparkSession
    place = f"{path}/_batch_id={backfill_number(name)}"
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
    if marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker):
        return False
    df.write.mode("overwrite").parquet(place)
    return True
