"""Data-quality rules: warn, drop, fail, quarantine and pass rates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminae.functions.audit import instant

# Rule actions.
ACTIONS = ["warn", "drop", "fail"]


@dataclass(frozen=True)
class Rule:
    name: str
    constraint: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"rule {self.name}: unknown action {self.action!r}")

    def holds(self) -> Column:
        """A constraint that evaluates to NULL does not hold."""
        return F.coalesce(F.expr(self.constraint), F.lit(False))


def of_action(rules: list[Rule], action: str) -> list[Rule]:
    return [r for r in rules if r.action == action]


def expect_drop(df: DataFrame, rules: list[Rule]) -> DataFrame:
    for rule in rules:
        df = df.where(rule.holds())
    return df


def expect_fail(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Abort on the first violating row. The check sits in a filter: as an unused column it would
    be pruned and bad data would pass."""
    for rule in rules:
        message = F.lit(f"expectation failed: {rule.name} ({rule.constraint})")
        df = df.where(F.when(~rule.holds(), F.raise_error(message)).isNull())
    return df


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Enforce fail and drop rules; warn rules leave the rows alone."""
    return expect_drop(expect_fail(df, of_action(rules, "fail")), of_action(rules, "drop"))


def quality_metrics(df: DataFrame, rules: list[Rule], table: str) -> DataFrame:
    """(table, rule, action, passed, failed, failed_rate) from one aggregate over the table."""
    failed = [F.sum(F.when(r.holds(), 0).otherwise(1)) for r in rules]
    totals = df.agg(F.count(F.lit(1)).alias("_n"), *[F.coalesce(c, F.lit(0)).alias(f"_f{i}") for i, c in enumerate(failed)])
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(r.name).alias("rule_name"),
                F.lit(r.action).alias("action"),
                (F.col("_n") - F.col(f"_f{i}")).alias("passed"),
                F.col(f"_f{i}").alias("failed"),
                F.when(F.col("_n") > 0, F.round(F.col(f"_f{i}") / F.col("_n"), 6)).alias("failed_rate"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return totals.select(F.inline(rows))


def quarantine(df: DataFrame, rules: list[Rule], at=None) -> DataFrame:
    """Rows for which some warn rule is false.

    A rule that evaluates to NULL does not send a row here, and `_quarantine_expectations` names
    all warn rules; `_violated_expectations` adds the ones the row actually broke.
    """
    warn = of_action(rules, "warn")
    if not warn:
        return df.where(F.lit(False))
    broken = [~F.expr(r.constraint) for r in warn]
    condition = broken[0]
    for c in broken[1:]:
        condition = condition | c
    return df.where(condition).withColumns(
        {
            "_quarantine_timestamp": instant(at),
            "_quarantine_expectations": F.lit(",".join(r.name for r in warn)),
            "_violated_expectations": F.array_compact(F.array(*[F.when(c, r.name) for c, r in zip(broken, warn)])),
        }
    )


def flag_invalid(df: DataFrame, invalid: str, flag: str = "is_invalid") -> DataFrame:
    return df.withColumn(flag, F.when(F.expr(invalid), True).otherwise(False))


def split_flagged(df: DataFrame, flag: str = "is_invalid") -> tuple[DataFrame, DataFrame]:
    return df.where(~F.col(flag)).drop(flag), df.where(F.col(flag)).drop(flag)
