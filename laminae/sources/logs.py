"""Message-log sources. Reader options are built as plain dictionaries so they can be tested
without a broker; the decoding below runs on any frame with the log's column layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column layout of a log record and the default change topic.
LOG_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]
CHANGE_TOPIC = "dbserver1.{schema}.{table}"


def kafka_options(
    servers: str,
    topics: str | list[str],
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    security_protocol: str | None = None,
    sasl: dict | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if security_protocol:
        options["kafka.security.protocol"] = security_protocol
    if sasl:
        options["kafka.sasl.mechanism"] = sasl["mechanism"]
        module = "org.apache.kafka.common.security.plain.PlainLoginModule"
        options["kafka.sasl.jaas.config"] = (
            f'{module} required username="{sasl["username"]}" password="{sasl["password"]}";'
        )
    return options


def event_hub_options(namespace: str, hub: str, connection_string: str, **kwargs) -> dict[str, str]:
    """An event hub is reached through its Kafka-compatible endpoint."""
    return kafka_options(
        f"{namespace}.servicebus.windows.net:9093",
        hub,
        security_protocol="SASL_SSL",
        sasl={"mechanism": "PLAIN", "username": "$ConnectionString", "password": connection_string},
        **kwargs,
    )


def change_topic(schema: str, table: str, topic: str | None = None) -> str:
    return topic or CHANGE_TOPIC.format(schema=schema, table=table)


def stream_log(spark: SparkSession, options: dict[str, str], fmt: str = "kafka") -> DataFrame:
    return spark.readStream.format(fmt).options(**options).load()


def decode_envelope(df: DataFrame) -> DataFrame:
    """Binary key and value to text; position columns are kept for replay and lag checks."""
    return df.select(
        F.col("key").cast("string").alias("event_key"),
        F.col("value").cast("string").alias("event_value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("log_timestamp"),
    )


def parse_json(df: DataFrame, column: str, ddl: str, keep: list[str] | None = None) -> DataFrame:
    """Parse a JSON text column with a DDL schema and lift its fields to the top level."""
    parsed = df.withColumn("_parsed", F.from_json(column, ddl))
    others = keep if keep is not None else [c for c in df.columns if c != column]
    return parsed.select(*others, "_parsed.*")
