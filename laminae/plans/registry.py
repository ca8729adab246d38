"""Registry of named queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Fixed instants that stand for "now", so results do not depend on the clock.
EVENTS_NOW = "2024-01-31 00:00:00"
ORDERS_NOW = "2001-08-02 00:00:00"


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


class Tables:
    """Attribute access to the parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def at(instant: str):
    """A wall-clock literal."""
    return F.lit(instant).cast("timestamp_ntz")


def money(column):
    """Exact decimal of a two-digit amount; sums do not depend on row order."""
    col = F.col(column) if isinstance(column, str) else column
    return col.cast("decimal(18,2)")
