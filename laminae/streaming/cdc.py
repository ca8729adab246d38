"""Keyed state from a change stream, on plain files.

Every micro-batch is appended to a change log under its own number; writing a batch again replaces
it, so a restart cannot apply anything twice. Current rows and history are functions of the log,
which makes them independent of the order of arrival. `compact` folds the log into a base of
newest rows so that reads do not grow with its age.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from laminae.operators import scd
from laminae.sinks import versions
from laminae.streaming.basics import backfill_once, write_batches


_BACKFILLS = 1000  # fewer are expected of one table


class ChangeState:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: list[str],
        seq: list[str],
        delete_when: Column | None = None,
        except_columns: list[str] | None = None,
    ):
        self.spark, self.path, self.keys, self.seq = spark, path.rstrip("/"), keys, seq
        self.delete_when, self.except_columns = delete_when, except_columns or []

    def start(self, stream: DataFrame, mode: str = "triggered", interval: str = "60 seconds") -> StreamingQuery:
        return write_batches(stream, f"{self.path}/log", f"{self.path}/checkpoint", mode, interval)

    def log(self, after: int = -1) -> DataFrame:
        """Change events of batches numbered above `after`; the folder number prunes the others. Backfills have
        negative numbers and may come at any time, so they always belong to it: events applied twice change
        nothing."""
        df = self.spark.read.parquet(f"{self.path}/log")
        return df.where((F.col("_batch_id") > after) | (F.col("_batch_id") < 0)).drop("_batch_id")

    def backfill(self, df: DataFrame, name: str) -> bool:
        """Load earlier events once; False if that was done before."""
        return backfill_once(df, f"{self.path}/log", name)

    def newest_batch(self) -> int:
        """Number of the last finished batch, from the folder names."""
        return max([-1, *(int(v) for v in versions.committed(self.spark, f"{self.path}/log", "_batch_id="))])

    def _newest(self, keep_tombstones: bool) -> DataFrame:
        base_version = versions.latest_version(self.spark, f"{self.path}/base")
        base = versions.read_version(self.spark, f"{self.path}/base", base_version) if base_version else None
        return scd.cdc_scd1(
            self.log(base_version - 1), self.keys, self.seq, self.delete_when, self.except_columns, base, keep_tombstones
        )

    def current(self) -> DataFrame:
        return self._newest(False)

    def compact(self) -> int:
        """Fold all batches so far into the base, tombstones included: a late event that a delete
        has overtaken must still lose. Base version N holds batches 0 to N-1."""
        upto = self.newest_batch()
        if versions.latest_version(self.spark, f"{self.path}/base") <= upto:
            versions.write_version(self._newest(True), f"{self.path}/base", upto + 1)
        return upto

    def history(self, **cdc) -> DataFrame:
        """SCD2 versions from the whole log."""
        return scd.cdc_scd2(self.log(), self.keys, self.seq, self.delete_when, self.except_columns, **cdc)

    def refresh_history(self, **cdc) -> int:
        """Bring the stored history up to the newest batch, rebuilding only keys with new events. A version is
        numbered by the batches and the backfills that it holds."""
        place, upto = f"{self.path}/history", self.newest_batch()
        backfills = sum(int(v) < 0 for v in versions.committed(self.spark, f"{self.path}/log", "_batch_id="))
        if backfills >= _BACKFILLS:
            raise ValueError(f"more than {_BACKFILLS - 1} backfills")
        done, number = versions.latest_version(self.spark, place), (upto + 1) * _BACKFILLS + backfills
        if done >= number:
            return upto
        if not done:
            fresh = self.history(**cdc)
        else:
            options = {"seq": self.seq, "delete_when": self.delete_when, "except_columns": self.except_columns, **cdc}
            stored = versions.read_version(self.spark, place, done)
            touched = self.log(done // _BACKFILLS - 1)
            if done % _BACKFILLS == backfills:
                touched = self.spark.read.parquet(f"{self.path}/log").where(F.col("_batch_id") >= done // _BACKFILLS)
            fresh = scd.merge_history(stored, self.log(), touched, self.keys, **options)
        versions.write_version(fresh, place, number)
        return upto

    def stored_history(self) -> DataFrame:
        return versions.read_version(self.spark, f"{self.path}/history")
