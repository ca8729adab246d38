"""Row filters, column masks and SQL functions, applied as projections of a secured view."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: shape of an identifier accepted in generated SQL.
IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_]*$"


def checked_identifier(name: str) -> str:
    if not re.match(IDENTIFIER, name):
        raise ValueError(f"invalid identifier {name!r}")
    return name


def create_function(spark: SparkSession, name: str, parameters: str, returns: str, body: str) -> None:
    """A scalar SQL function of the session; Catalyst inlines its body into the plan."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {checked_identifier(name)}({parameters}) RETURNS {returns} RETURN {body}")


def call(name: str, columns: list[str]) -> Column:
    return F.expr(f"{checked_identifier(name)}({', '.join(checked_identifier(c) for c in columns)})")


def member_of(groups: list[str], group: str) -> Column:
    """Group membership is an argument: the caller states the reader's groups."""
    return F.lit(group in groups)


class SecuredView:
    """A frame with a row filter and column masks that can be set and dropped."""

    def __init__(self, df: DataFrame):
        self._df, self._filter, self._masks = df, None, {}

    def set_row_filter(self, condition: Column) -> "SecuredView":
        self._filter = condition
        return self

    def drop_row_filter(self) -> "SecuredView":
        self._filter = None
        return self

    def set_mask(self, column: str, masked: Column) -> "SecuredView":
        if column not in self._df.columns:
            raise ValueError(f"no column {column!r}")
        self._masks[column] = masked.cast(self._df.schema[column].dataType)
        return self

    def drop_mask(self, column: str) -> "SecuredView":
        self._masks.pop(column, None)
        return self

    def read(self) -> DataFrame:
        """The filter sees unmasked values; a NULL outcome hides the row."""
        rows = self._df if self._filter is None else self._df.where(self._filter)
        return rows.select(*[self._masks[c].alias(c) if c in self._masks else F.col(c) for c in self._df.columns])
