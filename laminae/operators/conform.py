"""Silver transformations declared as a list of steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminae.functions.audit import instant

# Literals read as missing.
NULL_LITERALS = ["NULL", "null", "N/A", ""]


def _strings(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def add_column(df: DataFrame, name: str, expression: str) -> DataFrame:
    return df.withColumn(name, F.expr(expression))


def trim_strings(df: DataFrame, columns="all") -> DataFrame:
    chosen = [c for c in _strings(df) if columns == "all" or c in columns]
    return df.withColumns({c: F.trim(c) for c in chosen}) if chosen else df


def null_standardize(df: DataFrame, values: list[str] | None = None) -> DataFrame:
    missing = list(NULL_LITERALS if values is None else values)
    chosen = _strings(df)
    return df.withColumns({c: F.when(~F.col(c).isin(missing), F.col(c)) for c in chosen}) if chosen else df


def rename_column(df: DataFrame, **kw) -> DataFrame:
    return df.withColumnRenamed(kw["from"], kw["to"])


def cast_column(df: DataFrame, column: str, target_type: str, safe: bool = False) -> DataFrame:
    """`safe` turns values that do not convert into NULL; otherwise they fail the job."""
    source = F.col(column)
    return df.withColumn(column, source.try_cast(target_type) if safe else source.cast(target_type))


def drop_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.drop(*columns)


STEPS = {
    "add_column": add_column,
    "trim_strings": trim_strings,
    "null_standardize": null_standardize,
    "rename_column": rename_column,
    "cast": cast_column,
    "drop_columns": drop_columns,
}


def conform(df: DataFrame, steps: list[dict], at=None, current=None) -> DataFrame:
    """Run the steps in order, then add the silver audit columns. All of them are projections that
    Spark compiles into one stage. `current` overrides `_is_current` (a history table knows better)."""
    for step in steps:
        kind = step.get("type")
        if kind not in STEPS:
            raise ValueError(f"unknown transformation {kind!r}")
        df = STEPS[kind](df, **{k: v for k, v in step.items() if k != "type"})
    return df.withColumns(
        {"_silver_timestamp": instant(at), "_is_current": F.lit(True) if current is None else current}
    )
