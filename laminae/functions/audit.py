"""Load-audit columns added at the first layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the audit columns.
AUDIT_COLUMNS = [
    "_ingestion_timestamp",
    "_source_system",
    "_source_database",
    "_source_schema",
    "_source_table",
    "_load_type",
]


def instant(value=None) -> Column:
    """A given instant as a timestamp literal; the clock only when none is given."""
    if value is None:
        return F.current_timestamp()
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def with_ingest_metadata(
    df: DataFrame, system: str, database: str, schema: str, table: str, load_type: str, at=None
) -> DataFrame:
    values = [instant(at)] + [F.lit(v) for v in (system, database, schema, table, load_type)]
    return df.withColumns(dict(zip(AUDIT_COLUMNS, values)))
