"""Streams started from a table's contract: rates, triggers, checkpoint, schema, rules and their measures.

The schema that a stream reads is kept beside its checkpoint. Each start compares it with what the source holds
now: a contract that evolves goes on with both merged, a strict one refuses to start. Every micro-batch is
written under its own number, and the pass rates of its rules are measured by the very job that writes it,
so no row is read twice; a batch that is repeated replaces both.
"""

from __future__ import annotations

import json
import warnings

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from laminae.config import TableContract
from laminae.functions.audit import with_ingest_metadata
from laminae.operators import drift, quality
from laminae.sinks import versions
from laminae.sources import files
from laminae.streaming.basics import trigger_options

_METRICS = "table_name string, rule_name string, action string, passed bigint, failed bigint"


def write_measured(df: DataFrame, rules: list[quality.Rule], path: str) -> list[tuple[str, str, int, int]]:
    """Write what the rules let pass; returns (rule, action, passed, failed), counted while writing."""
    if not rules:
        df.write.mode("overwrite").parquet(path)
        return []
    seen = Observation()
    failed = [F.sum(F.when(r.holds(), 0).otherwise(1)).alias(f"f{i}") for i, r in enumerate(rules)]
    quality.apply_rules(df.observe(seen, F.count(F.lit(1)).alias("n"), *failed), rules).write.mode("overwrite").parquet(path)
    got = seen.get
    n = got["n"] or 0
    return [(r.name, r.action, n - (got[f"f{i}"] or 0), got[f"f{i}"] or 0) for i, r in enumerate(rules)]


class ContractStream:
    def __init__(self, spark: SparkSession, contract: TableContract, source: str, base: str, fmt: str = "parquet"):
        if contract.stream is None:
            raise ValueError(f"{contract.target_name} declares no stream")
        self.spark, self.contract, self.source, self.fmt = spark, contract, source, fmt
        self.base = base.rstrip("/")
        # an environment without a checkpoint base leaves this to the lake
        named = contract.stream.checkpoint_location
        self.checkpoint = named if not named.startswith("/bronze/") else f"{self.base}/checkpoints{named}"

    def _place(self, *names: str) -> str:
        return "/".join([self.base, *names, self.contract.target_name])

    # ---- schema ----------------------------------------------------------------------------------

    def known_schema(self) -> T.StructType | None:
        stored = versions.read_version(self.spark, f"{self.checkpoint}-schema")
        return T.StructType.fromJson(json.loads(stored.head().schema)) if stored is not None else None

    def schema(self) -> T.StructType:
        """The schema to read with, after the source's has been held against the one that is kept."""
        merge = {"mergeSchema": "true"} if self.fmt == "parquet" else {}
        now, known = files.scan_files(self.spark, self.source, self.fmt, **merge).schema, self.known_schema()
        settings = self.contract.drift
        change = drift.detect(now, known)
        if change and settings["mode"] == "strict":
            drift.enforce(change, settings["allowed_changes"])
        merged = drift.common_type(known, now, self.contract.target_name) if known else now
        if known is None or merged != known:
            if change and settings["alert_on_drift"]:
                warnings.warn(f"{self.contract.target_name}: schema drift {change.by_kind()}", stacklevel=2)
            row = self.spark.createDataFrame([(merged.json(),)], "schema string").coalesce(1)
            versions.write_version(row, f"{self.checkpoint}-schema")
        return merged

    # ---- the stream ------------------------------------------------------------------------------

    def start(self, mode: str = "triggered", at=None) -> StreamingQuery:
        """Start, or go on from the checkpoint. `triggered` drains what is there in batches of the contract's rate;
        `continuous` takes a batch each trigger interval."""
        c, settings = self.contract, self.contract.stream
        stream = files.stream_files(self.spark, self.source, self.fmt, self.schema(), max_files_per_trigger=settings.max_offsets_per_trigger)

        def write(batch: DataFrame, number: int) -> None:
            loaded = with_ingest_metadata(batch, c.source, c.database, c.source_schema, c.source_table, c.strategy, at)
            rates = write_measured(loaded, list(c.rules), f"{self._place('raw')}/_batch_id={number}")
            if rates:
                rows = batch.sparkSession.createDataFrame([(c.target_name, *r) for r in rates], _METRICS)
                rows.coalesce(1).write.mode("overwrite").parquet(f"{self._place('control/stream_quality')}/_batch_id={number}")

        return (
            stream.writeStream.foreachBatch(write)
            .outputMode(settings.output_mode)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**trigger_options(mode, settings.trigger_interval))
            .start()
        )

    def rows(self) -> DataFrame:
        """All rows so far, with the columns of the kept schema; older batches have nulls in newer ones."""
        known = self.known_schema()
        stored = self.spark.read.option("mergeSchema", "true").parquet(self._place("raw")).drop("_batch_id")
        missing = [f for f in known.fields if f.name not in stored.columns]
        return stored.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else stored

    def quality(self) -> DataFrame:
        """Passed and failed rows of each rule over all batches."""
        measured = self.spark.read.parquet(self._place("control/stream_quality"))
        return measured.groupBy("table_name", "rule_name", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were dropped, from the state operators' own counts in the progress
    that the session keeps (spark.sql.streaming.numRecentProgressUpdates batches). Exact where rows reach the
    state one by one, as in removing duplicates; an aggregate counts its groups."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
