"""From a contract and its source's settings to a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from laminae.config import ContractError, TableContract
from laminae.sources import files, jdbc, logs, tables


def read_batch(spark: SparkSession, contract: TableContract, source: dict, last_value=None) -> DataFrame:
    """`source` is {type: catalog|jdbc|files, ...}; increments are filtered at the source."""
    kind = source["type"]
    if kind == "catalog":
        parts = [source.get("catalog") or contract.database, contract.source_schema, contract.source_table]
        df = tables.scan_table(spark, ".".join(p for p in parts if p))
    elif kind == "jdbc":
        server = jdbc.JdbcSource(
            source["url"], source["driver"], source.get("user"), source.get("password"), source.get("options", {})
        )
        name = f"{contract.source_schema}.{contract.source_table}" if contract.source_schema else contract.source_table
        df = jdbc.scan_jdbc(
            spark, server, name, contract.fetch_size, source.get("split_column"), int(source.get("partitions", 1))
        )
    elif kind == "files":
        df = files.scan_files(spark, source["path"].format(table=contract.source_table), source.get("format", "parquet"))
    else:
        raise ContractError(f"unsupported batch source {kind!r}")
    if contract.strategy == "incremental" and contract.watermark_column:
        return tables.above_watermark(df, contract.watermark_column, last_value)
    return df


def read_stream(spark: SparkSession, contract: TableContract, source: dict) -> DataFrame:
    kind = contract.stream.source_type if contract.stream else "cdc"
    limit = contract.stream.max_offsets_per_trigger if contract.stream else None
    if kind == "files":
        return files.stream_files(
            spark, source["path"].format(table=contract.source_table), source.get("format", "json"), source.get("schema"),
            evolve=contract.drift["mode"] == "auto_evolve", max_files_per_trigger=source.get("max_files_per_trigger"),
        )
    if kind not in ("kafka", "cdc", "eventhub"):
        raise ContractError(f"unsupported stream source {kind!r}")
    if kind == "eventhub":
        hub = source["eventhub"]
        options = logs.event_hub_options(
            hub["namespace"], hub["name"], hub["connection_string"],
            starting_offsets=hub.get("starting_position", "earliest"), max_offsets_per_trigger=limit,
        )
        return logs.stream_log(spark, options)
    log = source["kafka"]
    topic = log.get("topic")
    if kind == "cdc":
        topic = logs.change_topic(contract.source_schema, contract.source_table, contract.topic or topic)
    options = logs.kafka_options(
        log["servers"], topic, log.get("starting_offsets", "earliest"), limit, log.get("security_protocol"), log.get("sasl")
    )
    return logs.stream_log(spark, options)
