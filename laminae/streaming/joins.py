"""Stream joins; both also work on batch frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminae.streaming.basics import event_time


def with_dimension(stream: DataFrame, dimension: DataFrame, on, columns: list[str]) -> DataFrame:
    """Left join with a static table. The size of the static side decides between a broadcast and a
    shuffle (`spark.sql.autoBroadcastJoinThreshold`); nothing is forced."""
    return stream.join(dimension.select(*columns), on, "left")


def interval(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    hours: int = 1,
    delay: str = "1 hour",
) -> DataFrame:
    """Pairs of equal key where the right event happens within `hours` after the left one.

    Rows meet by (key, time bucket): a right row sits in its own bucket, a left row in its own and
    the next, one bucket being the interval's length. A hot key is divided over its buckets and
    only neighbours in time are compared. On streams the time bound lets Spark drop old state.
    """
    width = hours * 3600
    bucket = lambda c: F.floor(F.unix_timestamp(F.col(c).cast("timestamp")) / width)
    a = event_time(left, left_ts, delay).withColumn("_bucket", F.explode(F.array(bucket(left_ts), bucket(left_ts) + 1)))
    b = event_time(right, right_ts, delay).withColumnRenamed(key, "_right_key").withColumn("_right_bucket", bucket(right_ts))
    on = (F.col(key) == F.col("_right_key")) & (F.col("_bucket") == F.col("_right_bucket"))
    on = on & (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {hours} HOURS"))
    return a.join(b, on).drop("_bucket", "_right_key", "_right_bucket")
