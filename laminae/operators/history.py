"""Queries over version history (`__START_AT` inclusive, `__END_AT` exclusive, NULL = current)."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laminae.operators.ordered import FEW, carry_last, same_keys
from laminae.operators.scd import END, START
from laminae.session import cut_lineage

# Fixed value: end of an open version in the standard view.
OPEN_END = "9999-12-31"
MOST = 256  # versions of a key that a fact is compared with one by one


def current(history: DataFrame) -> DataFrame:
    return history.where(F.col(END).isNull())


def covers(at: Column, start: Column, end: Column) -> Column:
    return (start <= at) & ((end > at) | end.isNull())


def as_of(history: DataFrame, at: Column) -> DataFrame:
    return history.where(covers(at, F.col(START), F.col(END)))


def versions(history: DataFrame, as_of_time: Column) -> DataFrame:
    """All versions with the days each was (or has been) active."""
    until = F.coalesce(F.col(END), as_of_time)
    return history.withColumn("days_active", F.datediff(until, F.col(START)))


def changes_between(history: DataFrame, keys: list[str], low: Column, high: Column) -> DataFrame:
    """Versions opened in the period, other than each key's first one."""
    firsts = history.groupBy(*keys).agg(F.min(START).alias("_first")).alias("f")
    h = history.where(F.col(START).between(low, high)).alias("h")
    return (
        h.join(firsts, same_keys("h", "f", keys))
        .where(F.col(f"h.{START}") != F.col("_first"))
        .select("h.*", F.lit("UPDATE").alias("change_type"))
    )


def changed_since(history: DataFrame, since: Column) -> DataFrame:
    return history.where(F.col(START) >= since)


def change_stats(history: DataFrame, keys: list[str]) -> DataFrame:
    return history.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("version_count"),
        F.min(START).alias("first_seen"),
        F.max(START).alias("last_updated"),
    )


def standard_view(history: DataFrame) -> DataFrame:
    return history.select(
        *[c for c in history.columns if c not in (START, END)],
        F.col(START).alias("valid_from"),
        F.coalesce(F.col(END), F.lit(OPEN_END).cast(history.schema[END].dataType)).alias("valid_to"),
        F.col(END).isNull().alias("is_current"),
    )


def join_as_of(
    facts: DataFrame,
    history: DataFrame,
    keys: list[str],
    at: str,
    columns: list[str],
    how: str = "inner",
    limit: int | None = None,
    short: bool = False,
) -> DataFrame:
    """Each fact with the version valid at its own time. Versions of a key must not overlap, as in any history.

    A `short` history (a row a class and month, say) is written first; if it holds FEW rows, and MOST of a key, it is
    sent to every task and no fact moves. Any other history is joined by a sweep.

    A sweep: facts and versions are read as one list in order of key and time, and each fact takes the last
    version that started before it, if that has not ended. Every row is shuffled once and no version is listed
    more than once. A key with more than `limit` rows is divided along time, and the version in force is carried
    over each border.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown kind of join {how!r}")
    moment = lambda c: F.col(c).cast("timestamp_ntz")
    if short:
        history = cut_lineage(history.select(*keys, START, END, *[c for c in columns if c not in keys]), "versions")
        size = history.groupBy(*keys).count().agg(F.sum("count").alias("all"), F.max("count").alias("most")).head()
        if (size["all"] or 0) <= FEW and (size.most or 0) <= MOST:
            known = history.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], moment(START).alias("_from"), moment(END).alias("_until"), F.struct(*columns).alias("_row"))
            own = facts.select(*[F.col(k).alias(f"_f{i}") for i, k in enumerate(keys)], moment(at).alias("_at"), F.struct(*facts.columns).alias("_fact"))
            same = [F.col(f"_f{i}").eqNullSafe(F.col(f"_k{i}")) for i in range(len(keys))]
            joined = own.join(F.broadcast(known), reduce(and_, [*same, covers(F.col("_at"), F.col("_from"), F.col("_until"))]), how)
            return joined.select("_fact.*", *[F.col(f"_row.{c}").alias(c) for c in columns])
    key = lambda df: [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    version = F.struct(moment(END).alias("until"), F.struct(*columns).alias("row")).alias("_version")
    fact = F.struct(*facts.columns).alias("_fact")
    known = history.select(*key(history), moment(START).alias("_at"), F.lit(0).alias("_kind"), version)
    asked = facts.select(*key(facts), moment(at).alias("_at"), F.lit(1).alias("_kind"), fact)
    listed = asked.unionByName(known, allowMissingColumns=True)
    swept = carry_last(listed, names, ["_at", "_kind"], F.col("_version"), "_found", F.lit(0), limit).where("_kind = 1")
    valid = F.col("_at").isNotNull() & F.col("_found").isNotNull() & (F.col("_found.until").isNull() | (F.col("_found.until") > F.col("_at")))
    swept = swept.where(valid) if how == "inner" else swept.withColumn("_found", F.when(valid, F.col("_found")))
    return swept.select("_fact.*", *[F.col(f"_found.row.{c}").alias(c) for c in columns])


def join_current(facts: DataFrame, history: DataFrame, keys: list[str], columns: list[str], how: str = "inner") -> DataFrame:
    h = current(history).select(*keys, *columns).alias("h")
    f = facts.alias("f")
    return f.join(h, same_keys("f", "h", keys), how).select(
        *[F.col(f"f.{c}") for c in facts.columns], *[F.col(f"h.{c}") for c in columns]
    )


def version_numbers(history: DataFrame, keys: list[str]) -> DataFrame:
    return history.withColumn("version", F.row_number().over(W.partitionBy(*keys).orderBy(START)))
