"""Three-sigma outliers against a key's recent rows, on batches and on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.streaming import StreamingQuery

from laminae.operators.ordered import day_segment, rolling
from laminae.sinks import versions
from laminae.streaming.basics import trigger_options

# The flags, the width of the band in standard deviations and the frame.
HIGH, LOW, NORMAL = "HIGH_OUTLIER", "LOW_OUTLIER", "NORMAL"
SIGMAS = 3
PRECEDING = 100


def anomaly_flag(value: str, mean: str, deviation: str) -> Column:
    band = F.lit(SIGMAS) * F.col(deviation)
    v, m = F.col(value), F.col(mean)
    return F.when(v > m + band, HIGH).when(v < m - band, LOW).otherwise(NORMAL)


def flagged(df: DataFrame, keys: list[str], order: list[str], value: str, segment: Column | None = None) -> DataFrame:
    stats = {"_mean": F.avg(value), "_sd": F.stddev_samp(value)}
    rolled = rolling(df, keys, order, segment if segment is not None else day_segment(order[0]), PRECEDING, stats)
    return rolled.withColumn("anomaly_flag", anomaly_flag(value, "_mean", "_sd")).drop("_mean", "_sd")


def route(stream: DataFrame, keys: list[str], order: list[str], value: str, path: str, checkpoint: str, mode: str = "triggered", interval: str = "60 seconds") -> StreamingQuery:
    """Outliers of every micro-batch to `path/alerts`. The last rows of each key are kept as a
    versioned tail (version N follows batch N-1), so frames reach back into earlier batches and a
    repeated batch reads the same tail again."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tail = versions.read_version(spark, f"{path}/tail", batch_id) if batch_id else None
        rows = batch.withColumn("_new", F.lit(True))
        if tail is not None:
            rows = tail.withColumn("_new", F.lit(False)).unionByName(rows)
        alerts = flagged(rows, keys, order, value).where(F.col("_new") & (F.col("anomaly_flag") != NORMAL)).drop("_new")
        alerts.write.mode("overwrite").parquet(f"{path}/alerts/_batch_id={batch_id}")
        newest = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
        kept = rows.drop("_new").withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= PRECEDING).drop("_rn")
        versions.write_version(kept, f"{path}/tail", batch_id + 1)

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(**trigger_options(mode, interval)).start()
