"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on; sizes are left to the cluster's own defaults and to AQE.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "laminae", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. A machine-local one is made only for a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="laminae-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write the frame to the shared folder and read it back: later steps start from the files, so
    a lost executor never makes the whole chain run again, and nothing is computed twice (an eager
    checkpoint runs its input once to count and once to save). The shuffle files of the write are
    removed at its end, as nothing reads them again."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions inside leave no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before else spark.conf.unset(CLEANUP)


def drop_scratch(*frames: DataFrame) -> None:
    """Deletes the folders of frames that cut_lineage wrote, once nothing reads them any more."""
    for df in frames:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            target = spark._jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one, for a table written once and read back."""
    return f"{shared_dir(spark).rstrip('/')}/laminae/{label}-{uuid.uuid4().hex}"
