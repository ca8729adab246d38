"""Relational sources read through Spark's JDBC data source."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminae.sources.tables import above_watermark


@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str
    user: str | None = None
    password: str | None = None
    options: dict = field(default_factory=dict)

    def option_map(self) -> dict[str, str]:
        out = {"url": self.url, "driver": self.driver, **{k: str(v) for k, v in self.options.items()}}
        if self.user is not None:
            out["user"] = self.user
        if self.password is not None:
            out["password"] = self.password
        return out


# Default ports and URL shapes of the two supported servers.
DEFAULT_PORTS = {"sqlserver": 1433, "postgresql": 5432}
URL_SHAPES = {
    "postgresql": "jdbc:postgresql://{host}:{port}/{database}",
    "sqlserver": "jdbc:sqlserver://{host}:{port};database={database};encrypt=true;trustServerCertificate=true",
}


def server_url(kind: str, host: str, database: str, port: int | None = None) -> str:
    if kind not in URL_SHAPES:
        raise ValueError(f"no JDBC URL shape for {kind!r}")
    return URL_SHAPES[kind].format(host=host, port=port or DEFAULT_PORTS[kind], database=database)


def column_bounds(spark: SparkSession, source: JdbcSource, table: str, column: str) -> tuple | None:
    """Smallest and largest value of the split column, computed by the database (one row back)."""
    row = (
        spark.read.format("jdbc")
        .options(**source.option_map())
        .option("dbtable", table)
        .option("pushDownAggregate", "true")
        .load()
        .agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        .head()
    )
    return None if row is None or row.lo is None else (row.lo, row.hi)


def scan_jdbc(
    spark: SparkSession,
    source: JdbcSource,
    table: str,
    fetch_size: int = 10_000,
    split_column: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Read a table; with a split column the read is divided into that many range queries."""
    reader = (
        spark.read.format("jdbc")
        .options(**source.option_map())
        .option("dbtable", table)
        .option("fetchsize", str(fetch_size))
    )
    if split_column and partitions > 1:
        bounds = column_bounds(spark, source, table, split_column)
        if bounds:
            reader = (
                reader.option("partitionColumn", split_column)
                .option("lowerBound", str(bounds[0]))
                .option("upperBound", str(bounds[1]))
                .option("numPartitions", str(partitions))
            )
    return reader.load()


def scan_jdbc_incremental(
    spark: SparkSession, source: JdbcSource, table: str, column: str, last_value, **kwargs
) -> DataFrame:
    """The watermark predicate is an ordinary filter, which the JDBC source pushes to the server."""
    return above_watermark(scan_jdbc(spark, source, table, **kwargs), column, last_value)


def foreign_table(spark: SparkSession, source: JdbcSource, table: str, view: str, **kwargs) -> DataFrame:
    """Expose a remote table under a local view name."""
    df = scan_jdbc(spark, source, table, **kwargs)
    df.createOrReplaceTempView(view)
    return df
