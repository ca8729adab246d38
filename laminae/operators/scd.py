"""Keyed state: newest row per key, snapshot diffs and change-stream apply (SCD type 1 and 2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from laminae.operators.drift import evolve_union
from laminae.operators.ordered import celled, day_segment, same_keys

# Interval columns of a history table and the default delete markers.
START, END = "__START_AT", "__END_AT"
DELETE_VALUES = ["d", "delete", "DELETE"]


def _orderable(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if not isinstance(df.schema[n].dataType, (T.MapType, T.VariantType))]


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key; no key means nothing to do.

    `row_number() = 1` lets Spark keep one row per key in every map task before the shuffle
    (window group limit), so a hot key moves one row per task. Remaining columns close the order,
    which makes ties deterministic.
    """
    if not keys:
        return df
    rest = _orderable(df, [c for c in df.columns if c not in keys and c not in order])
    newest = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in [*order, *rest]])
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def unique_by(df: DataFrame, keys: list[str], on_duplicate: str = "error", order: list[str] | None = None) -> DataFrame:
    """One row per key. `error` fails the job on a duplicate, `latest` keeps the newest row, `none`
    takes the caller's word that keys are unique. A key column that is NULL fails the job: such a
    row could never be matched with its stored version."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    df = df.where(F.when(missing, F.raise_error(F.lit(f"NULL in key {keys}"))).isNull())
    if on_duplicate == "none":
        return df
    if on_duplicate == "latest":
        return latest_per_key(df, keys, order or [])
    if on_duplicate != "error":
        raise ValueError(f"unknown duplicate policy {on_duplicate!r}")
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row"))
    message = F.concat(F.lit("duplicate key in snapshot: "), F.to_json(F.struct(*keys)))
    checked = packed.where(F.when(F.col("_n") > 1, F.raise_error(message)).isNull())
    return checked.select(*keys, "_row.*").select(*df.columns)


def _equal_keys(keys: list[str]) -> list[Column]:
    """Plain equality: keys are not NULL, and the partitioning of `unique_by` serves the join."""
    return [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]


def is_delete(op_column: str, delete_values: list[str] | None = None) -> Column:
    """Operation marker compared without regard to case."""
    values = sorted({v.lower() for v in (delete_values or DELETE_VALUES)})
    return F.coalesce(F.lower(F.col(op_column)).isin(values), F.lit(False))


def _tracked(columns: list[str], keys: list[str], track: list[str] | None, track_except: list[str] | None) -> list[str]:
    if track:
        return list(track)
    skip = set(keys) | set(track_except or [])
    return [c for c in columns if c not in skip]


def snapshot_changes(prev: DataFrame, snap: DataFrame, keys: list[str], on_duplicate: str = "error") -> DataFrame:
    """Snapshot rows with `_change` (insert / update / delete / unchanged). Deleted keys carry the
    previous row. Rows are compared null-safely, so NULL to NULL is no change."""
    snap = unique_by(snap, keys, on_duplicate)
    values = [c for c in snap.columns if c not in keys]
    a, b = prev.withColumn("_in", F.lit(True)).alias("a"), snap.withColumn("_in", F.lit(True)).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in values], F.lit(True))
    change = (
        F.when(F.col("a._in").isNull(), "insert")
        .when(F.col("b._in").isNull(), "delete")
        .when(same, "unchanged")
        .otherwise("update")
    )
    gone = F.col("b._in").isNull()
    return a.join(b, _equal_keys(keys), "full_outer").select(
        *[F.when(gone, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in snap.columns],
        change.alias("_change"),
    )


def apply_snapshot_scd1(prev: DataFrame, snap: DataFrame, keys: list[str], on_duplicate: str = "error") -> DataFrame:
    """New state: insert, update, and delete keys missing from the snapshot."""
    if not keys:
        return snap
    return snapshot_changes(prev, snap, keys, on_duplicate).where("_change <> 'delete'").drop("_change")


def first_history(snap: DataFrame, version: Column) -> DataFrame:
    """History holding one open version per row of a first snapshot."""
    return snap.withColumn(START, version).withColumn(END, F.lit(None).cast(snap.select(version).schema[0].dataType))


def apply_snapshot_scd2(
    history: DataFrame,
    snap: DataFrame,
    keys: list[str],
    version: Column,
    track: list[str] | None = None,
    track_except: list[str] | None = None,
    on_duplicate: str = "error",
) -> DataFrame:
    """Close changed and missing keys at `version`, open changed and new ones.

    Changes outside the tracked columns update the open version in place. One join on the key
    over the open versions only; closed versions pass through untouched.
    """
    snap = unique_by(snap, keys, on_duplicate)
    tracked = _tracked(snap.columns, keys, track, track_except)
    open_rows = history.where(F.col(END).isNull()).withColumn("_in", F.lit(True)).alias("a")
    fresh = snap.withColumn("_in", F.lit(True)).alias("b")
    same = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in tracked], F.lit(True))
    had, has = F.col("a._in").isNotNull(), F.col("b._in").isNotNull()
    nothing = F.lit(None).cast(history.schema[END].dataType)

    def row(side: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in snap.columns], start.alias(START), end.alias(END))

    kept = F.when(had & has & same, row("b", F.col(f"a.{START}"), nothing))
    closed = F.when(had & (~has | ~same), row("a", F.col(f"a.{START}"), version))
    opened = F.when(has & (~had | ~same), row("b", version, nothing))
    moved = open_rows.join(fresh, _equal_keys(keys), "full_outer").select(
        F.inline(F.array_compact(F.array(kept, closed, opened)))
    )
    return history.where(F.col(END).isNotNull()).select(*moved.columns).unionByName(moved)


def cdc_scd1(
    events: DataFrame,
    keys: list[str],
    seq: list[str],
    delete_when: Column | None = None,
    except_columns: list[str] | None = None,
    state: DataFrame | None = None,
    keep_tombstones: bool = False,
) -> DataFrame:
    """Current rows from a change stream in any arrival order.

    With `state` (rows kept with `keep_tombstones`) a late event is compared with what is stored,
    including remembered deletes. No key means every event is a row of its own.
    """
    if not keys:
        return events.drop(*(except_columns or []))
    marked = events.withColumn("_deleted", delete_when if delete_when is not None else F.lit(False))
    marked = marked.drop(*[c for c in (except_columns or []) if c not in seq])
    if state is not None:
        marked = evolve_union(state, marked)
    newest = latest_per_key(marked, keys, seq)
    if keep_tombstones:
        return newest
    return newest.where(~F.col("_deleted")).drop("_deleted", *[c for c in (except_columns or []) if c in seq])


def cdc_scd2(
    events: DataFrame,
    keys: list[str],
    seq: list[str],
    delete_when: Column | None = None,
    except_columns: list[str] | None = None,
    track: list[str] | None = None,
    track_except: list[str] | None = None,
    segment: Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Version history from a complete change log, in any arrival order.

    A version opens where the tracked columns differ from the key's preceding event (or follow a
    delete) and closes at the next such event; a delete only closes. Untracked columns take their
    last value within the version. The sequence columns are not tracked unless listed. `segment`
    is a monotone function of the sequence (default: the day of its first column); segments of a
    key with more than `limit` events are divided further.
    """
    segment = segment if segment is not None else day_segment(seq[0])
    visible = [c for c in events.columns if c not in (except_columns or [])]
    tracked = _tracked(visible, keys, track, [*(track_except or []), *seq])
    log = events.withColumn("_deleted", delete_when if delete_when is not None else F.lit(False))
    log = log.withColumn("_tracked", F.struct(*tracked) if tracked else F.struct(F.lit(1)))
    log = celled(log, keys, segment, seq, limit)
    # An event delivered twice equals its neighbour and neither opens nor closes anything. Events
    # that share a sequence value are ordered by content, so every run orders them alike.
    order = [*seq, "_deleted", *_orderable(log, tracked)]
    alive, at = ~F.col("_deleted"), F.col(seq[0])
    mark = F.struct(at.alias("at"), F.col("_deleted").alias("gone"), F.col("_tracked").alias("row"))

    def same_version(side: str) -> Column:
        near = F.col(side)
        return near.isNotNull() & ~near["gone"] & near["row"].eqNullSafe(F.col("_tracked"))

    # Versions as far as one cell (key and segment) shows them. One shuffle, one sort.
    within = W.partitionBy("_cell").orderBy(*order)
    sofar = within.rowsBetween(W.unboundedPreceding, 0)
    local = log.withColumns({"_p": F.lag(mark).over(within), "_n": F.lead(mark).over(within)})
    local = local.withColumns({"_first": F.col("_p").isNull(), "_last": F.col("_n").isNull(), "_end": F.col("_n.at")})
    opening = F.when(alive & ~same_version("_p"), F.struct(at.alias("at"), F.col("_first").alias("first")))
    local = local.withColumn("_open", F.last(opening, ignorenulls=True).over(sofar))
    pieces = local.where((alive & ~same_version("_n")) | (F.col("_deleted") & (F.col("_first") | F.col("_last"))))
    pieces = pieces.withColumns(
        {
            "_first": F.when(alive, F.col("_open.first")).otherwise(F.col("_first")),
            "_start": F.when(alive, F.col("_open.at")).otherwise(at),
        }
    ).select(*dict.fromkeys([*keys, *visible, *order]), "_tracked", "_first", "_last", "_start", "_end")
    whole = pieces.where(alive & ~F.col("_first") & ~F.col("_last"))
    whole = whole.select(*visible, F.col("_start").alias(START), F.col("_end").alias(END))

    # Pieces at a cell border are joined up per key; there are at most a few per key and segment.
    ordered = W.partitionBy(*keys).orderBy(*order)
    edge = F.struct(F.col("_start").alias("at"), F.col("_deleted").alias("gone"), F.col("_tracked").alias("row"))
    border = pieces.where(F.col("_first") | F.col("_last"))
    border = border.withColumns({"_p": F.lag(edge).over(ordered), "_n": F.lead(edge).over(ordered)})
    begins = F.when(~(F.col("_first") & same_version("_p")), F.col("_start"))
    border = border.withColumns(
        {
            START: F.last(begins, ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, 0)),
            END: F.coalesce("_end", F.when(F.col("_last"), F.col("_n.at"))),
        }
    )
    return whole.unionByName(border.where(alive & ~(F.col("_last") & same_version("_n"))).select(*visible, START, END))


def merge_history(
    history: DataFrame, log: DataFrame, touched: DataFrame, keys: list[str], **cdc
) -> DataFrame:
    """Refresh only the keys that received events: their versions are rebuilt from the full log,
    so an event that arrives late splits an interval that was already closed."""
    wanted = touched.select(*keys).distinct().alias("t")
    rebuilt = cdc_scd2(log.alias("l").join(wanted, same_keys("l", "t", keys), "left_semi"), keys, **cdc)
    others = history.alias("h").join(wanted, same_keys("h", "t", keys), "left_anti")
    return others.unionByName(rebuilt)
