"""The layered run: bronze state by strategy, silver with quarantine, gold star.

Every table's state is a folder of committed versions. A run that finds no change writes none, so
running again on the same input leaves everything as it was. Increments and change logs go through a
journal: a run that dies at any write is carried on by the next one, which loses and doubles nothing.
"""

from __future__ import annotations

import hashlib
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminae.config import TableContract
from laminae.functions.audit import AUDIT_COLUMNS, with_ingest_metadata
from laminae.operators import drift as schema_drift
from laminae.operators import quality, reconcile, scd
from laminae.operators.conform import conform
from laminae.operators.control import Control
from laminae.operators.journal import Entry, Journal
from laminae.operators.ordered import same_keys
from laminae.plans import gold as star
from laminae.session import cut_lineage
from laminae.sinks import versions

Reader = Callable[[TableContract, object], DataFrame]

# Audit columns differ between loads of equal rows, so they never count as a change.
STAMPS = [*AUDIT_COLUMNS, "_silver_timestamp", "_quarantine_timestamp"]


@dataclass
class Step:
    layer: str
    table: str
    version: int
    changed: bool


@dataclass
class Run:
    spark: SparkSession
    base: str
    read: Reader
    at: datetime
    steps: list[Step] = field(default_factory=list)
    keep_versions: int = 3
    compact_after: int = 32

    def __post_init__(self):
        self.control = Control(self.spark, self.path("control"))

    def path(self, layer: str, table: str | None = None) -> str:
        return "/".join(p for p in [self.base.rstrip("/"), layer, table] if p)

    def stored(self, layer: str, table: str) -> DataFrame | None:
        return versions.read_version(self.spark, self.path(layer, table))

    def journal(self, c: TableContract) -> Journal:
        return Journal(self.spark, self.path("control/journal", c.target_name), self.path("raw", c.target_name))

    def commit(self, layer: str, table: str, df: DataFrame, key: list[str] | None = None) -> bool:
        """Write the next version. When it holds the same rows as the one before, it is taken back
        (until then readers see equal rows either way). Comparing what was written, instead of the
        frame, runs the frame once. `key=None` states that the rows are new."""
        place = self.path(layer, table)
        before = versions.latest_version(self.spark, place)
        number = versions.write_version(df, place, before + 1)
        if before and key is not None:
            old, new = (versions.read_version(self.spark, place, n) for n in (before, number))
            if _same_rows(old, new, key):
                versions.drop_version(self.spark, place, number)
                number = before
        versions.drop_versions(self.spark, place, self.keep_versions)
        self.steps.append(Step(layer, table, number, number != before))
        return number != before

    def instant(self):
        return F.lit(self.at).cast("timestamp")


def _same_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> bool:
    """Equal apart from load stamps. Hash sums settle the usual case (something changed) in one
    aggregate per side; only equal sums are then proven row by row."""
    columns = [c for c in new.columns if c not in STAMPS]
    if set(columns) != {c for c in old.columns if c not in STAMPS}:
        return False
    a, b = old.select(*columns), new.select(*columns)
    digest = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(columns)).cast("decimal(38,0)"))).head()
    if digest(a) != digest(b):
        return False
    if keys:
        return reconcile.full_compare(b, a, keys).isEmpty()
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def bronze(run: Run, c: TableContract) -> None:
    if c.strategy == "snapshot":
        prev = run.stored("bronze", c.target_name)
        _snapshot(run, c, prev, _delivered(run, c, prev, None), list(c.primary_key))
        return
    journal = run.journal(c)
    _apply(run, c, journal, land(run, c, recover(run, c)))
    if c.strategy != "incremental" and c.scd_type == 2:
        journal.compact(run.compact_after)
    journal.prune()


def _delivered(run: Run, c: TableContract, prev: DataFrame | None, mark: str | None) -> DataFrame:
    """What the source has above the watermark, checked for drift and by the rules, with audit columns."""
    source = run.read(c, mark)
    # the state has columns of its own, and a change log's operation is not kept in it
    known = prev.drop(scd.START, scd.END, "_deleted", *AUDIT_COLUMNS) if prev is not None else None
    change = schema_drift.check(source.drop(c.operation_column) if c.strategy == "cdc" else source, known, c.drift["mode"], c.drift["allowed_changes"])
    if change:
        row = schema_drift.drift_record(run.spark, c.target_name, source.schema, change, str(run.at))
        row.coalesce(1).write.mode("append").parquet(run.path("control", "schema_drift"))
        if c.drift["alert_on_drift"]:
            warnings.warn(f"{c.target_name}: schema drift {change.by_kind()}", stacklevel=2)
    if change or prev is None:
        text = source.schema.json()
        digest = hashlib.sha256(text.encode()).hexdigest()
        run.control.append("source_metadata", [(c.target_name, c.source_schema, c.source_table, digest, text, run.at)])
    loaded = with_ingest_metadata(source, c.source, c.database, c.source_schema, c.source_table, c.strategy, run.instant())
    return quality.apply_rules(loaded, list(c.rules))


def land(run: Run, c: TableContract, mark: str | None) -> int:
    """Write what the source has above the watermark as the next raw batch; returns its number."""
    return run.journal(c).land(_delivered(run, c, run.stored("bronze", c.target_name), mark))


def recover(run: Run, c: TableContract) -> str | None:
    """Apply what an earlier run landed and did not confirm; returns the watermark in force. A state from before
    there was a journal counts as confirmed."""
    journal = run.journal(c)
    version = versions.latest_version(run.spark, run.path("bronze", c.target_name))
    if version and not journal.started():
        journal.confirm(Entry(max(journal.batches(), default=0), 0, version, version, run.control.watermark(c.target_name)))
    for number in journal.pending():
        _apply(run, c, journal, number)
    return journal.position().watermark


def _snapshot(run: Run, c: TableContract, prev: DataFrame | None, loaded: DataFrame, key: list[str]) -> None:
    order = [c.sequence_by_column] if c.sequence_by_column else []
    snap = scd.unique_by(loaded, key, c.on_duplicate, order) if key else loaded
    if prev is not None:
        known = prev.drop(scd.START, scd.END)
        extra = [f for f in known.schema.fields if f.name not in snap.columns]
        snap = snap.withColumns({f.name: F.lit(None).cast(f.dataType) for f in extra}) if extra else snap
    if c.scd_type == 2 and key:
        if prev is None:
            state = scd.first_history(snap, run.instant())
        else:
            missing = [f for f in snap.schema.fields if f.name not in prev.columns]
            prev = prev.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else prev
            state = scd.apply_snapshot_scd2(prev, snap, key, run.instant(), track_except=STAMPS, on_duplicate="none")
        changed = run.commit("bronze", c.target_name, state, [*key, scd.START])
    else:
        changed = run.commit("bronze", c.target_name, snap, key)
    if c.audit["enabled"] and changed:
        batch = run.control.next_batch(c.target_name, run.at)
        place = run.path("audit", c.target_name)
        versions.append_audit(loaded, place, batch, run.at.date(), c.audit["partition_by"])
        versions.expire_audit(run.spark, place, run.at.date(), int(c.audit["retention_days"]))


def _apply(run: Run, c: TableContract, journal: Journal, number: int) -> None:
    """Bring bronze up to a raw batch. Batch, state and watermark are confirmed together."""
    raw = journal.batch(number)
    column = c.watermark_column if c.strategy == "incremental" else None
    high = F.max(column).cast("string") if column else F.lit(None).cast("string")
    top = raw.agg(F.count(F.lit(1)).alias("n"), high.alias("hi")).head()
    place, base = run.path("bronze", c.target_name), journal.position().version
    if not top.n:
        versions.drop_folder(run.spark, f"{journal.raw}/_batch_id={number}")
        run.steps.append(Step("bronze", c.target_name, base, False))
        return
    done = journal.apply(number, top.hi, top.n, lambda n, batch, version: _next_version(run, c, journal, n, batch, version))
    if column:
        run.control.set_watermark(c.target_name, column, done.watermark, done.rows, run.at)
    versions.drop_versions(run.spark, place, run.keep_versions)
    run.steps.append(Step("bronze", c.target_name, done.version, done.version != done.base))


def _next_version(run: Run, c: TableContract, journal: Journal, number: int, batch: DataFrame, base: int) -> int:
    """Write the state that follows from the base version and a batch, and return its number (the base's, if no
    row changes). Only the keys of the batch are computed and compared; others are passed through."""
    place, key = run.path("bronze", c.target_name), list(c.primary_key)
    prev = versions.read_version(run.spark, place, base) if base else None
    history = c.strategy != "incremental" and c.scd_type == 2 and bool(key)
    if not key:
        rows = batch if c.strategy == "incremental" else batch.drop(c.operation_column)
        return versions.write_version(rows if prev is None else schema_drift.evolve_union(prev, rows), place, base + 1)
    if prev is None:
        return versions.write_version(_fresh(c, None, journal.log(number) if history else batch), place, base + 1)
    wanted = cut_lineage(batch.select(*key).distinct(), "touched").alias("t")
    of_keys = lambda df, how: df.alias("d").join(wanted, same_keys("d", "t", key), how)
    old = of_keys(prev, "left_semi")
    fresh = cut_lineage(_fresh(c, old, of_keys(journal.log(number), "left_semi") if history else batch), "fresh")
    if _same_rows(old, fresh, [*key, scd.START] if history else key):
        return base
    others = of_keys(prev, "left_anti")
    state = schema_drift.evolve_union(others, fresh)
    return versions.write_version(state.select(*fresh.columns, *[x for x in state.columns if x not in fresh.columns]), place, base + 1)


def _fresh(c: TableContract, old: DataFrame | None, events: DataFrame) -> DataFrame:
    """State rows of the keys that have events: by strategy, newest rows or whole histories. Histories
    are rebuilt from all events of a key, so one that arrives late or twice is right."""
    key, order = list(c.primary_key), [c.sequence_by_column or "_ingestion_timestamp"]
    if c.strategy == "incremental":
        merged = events if old is None else schema_drift.evolve_union(old, events)
        return scd.latest_per_key(merged, key, list(dict.fromkeys([*order, "_ingestion_timestamp"])))
    gone = scd.is_delete(c.operation_column, list(c.delete_values)) if c.operation_column in events.columns else None
    if c.scd_type == 2:
        return scd.cdc_scd2(events, key, order, gone, [c.operation_column, *AUDIT_COLUMNS])
    return scd.cdc_scd1(events, key, order, gone, [c.operation_column], state=old, keep_tombstones=True)


def bronze_rows(run: Run, c: TableContract) -> DataFrame:
    """What silver reads: current rows, without remembered deletes."""
    df = run.stored("bronze", c.target_name)
    return df.where(~F.col("_deleted")).drop("_deleted") if "_deleted" in df.columns else df


def silver(run: Run, c: TableContract) -> None:
    state = bronze_rows(run, c)
    current = F.col(scd.END).isNull() if scd.END in state.columns else None
    shaped = conform(state, list(c.steps), run.instant(), current)
    clean = quality.apply_rules(shaped, list(c.rules))
    stored = run.stored("silver", c.target_name)
    key = list(c.merge_keys)
    if c.silver_scd_type == 2 and key and scd.END not in state.columns:
        if stored is None:
            fresh = scd.first_history(clean, run.instant())
        else:
            moved = scd.apply_snapshot_scd2(stored, clean, key, run.instant(), track_except=STAMPS)
            fresh = moved.withColumn("_is_current", F.col(scd.END).isNull())
        changed = run.commit("silver", c.target_name, fresh, [*key, scd.START])
    else:
        compare = [*key, scd.START] if scd.START in state.columns and key else key
        changed = run.commit("silver", c.target_name, clean, compare)
    if quality.of_action(list(c.rules), "warn"):
        run.commit("quarantine", c.target_name, quality.quarantine(shaped, list(c.rules), run.instant()), [])
    if c.rules and changed:
        rates = quality.quality_metrics(shaped, list(c.rules), c.target_name).withColumn("measured_at", run.instant())
        rates.coalesce(1).write.mode("append").parquet(run.path("control", "quality_metrics"))


def gold(run: Run, tables: list[str], models: list[star.Model]) -> None:
    layer: star.Silver = {}
    for t in tables:
        df = run.stored("silver", t)
        layer[t] = df.where(F.col(scd.END).isNull()) if scd.END in df.columns else df
    for model in star.in_order(models):
        stored = run.stored("gold", model.name)
        fresh = star.refresh(model, layer, stored, run.instant())
        key = [*model.natural_key, *([scd.START] if model.keeps_history else [])]
        run.commit("gold", model.name, fresh, key)


def reconcile_table(run: Run, c: TableContract) -> DataFrame:
    """Compare a full read of the source with the state by the contract's method, and log it."""
    source, state = run.read(c, None), bronze_rows(run, c)
    if scd.END in state.columns:
        state = state.where(F.col(scd.END).isNull())
    method, key = c.reconciliation["method"], list(c.primary_key)
    if method not in reconcile.METHODS:
        raise ValueError(f"unknown reconciliation method {method!r}")
    if method == "rowcount":
        r = reconcile.rowcount(source, state, c.target_name)
        details = F.format_string("source=%d state=%d", "source_rows", "state_rows")
        row = r.select("table_name", run.instant().alias("reconciliation_ts"), F.lit(method).alias("method"), "status", details.alias("details"))
    else:
        compare = reconcile.key_hash if method == "key_hash" else reconcile.full_compare
        row = reconcile.log_rows(compare(source, state, key, source.columns), c.target_name, method, run.instant())
    row.coalesce(1).write.mode("append").parquet(run.path("control", "reconciliation_log"))
    return row


def medallion_run(
    spark: SparkSession, base: str, contracts: list[TableContract], read: Reader, at: datetime, models: list[star.Model] | None = None
) -> list[Step]:
    """Bronze for all tables, then silver, then gold; the first error stops the run."""
    run = Run(spark, base, read, at)
    for c in contracts:
        bronze(run, c)
    for c in contracts:
        silver(run, c)
    for c in contracts:
        if c.reconciliation["enabled"]:
            reconcile_table(run, c)
    gold(run, [c.target_name for c in contracts], star.STAR if models is None else models)
    return run.steps
