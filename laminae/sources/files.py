"""Batch and streaming file readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"


def scan_files(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    reader = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    return (reader.schema(schema) if schema is not None else reader).load(path)


def hinted_schema(inferred: T.StructType, hints: str) -> T.StructType:
    """Replace the types of the hinted columns; hinted columns not yet present are appended."""
    wanted = {f.name: f for f in T._parse_datatype_string(hints).fields}
    fields = [wanted.pop(f.name, f) for f in inferred.fields]
    return T.StructType(fields + list(wanted.values()))


def scan_with_hints(spark: SparkSession, path: str, fmt: str, hints: str, full: bool = False, **options) -> DataFrame:
    """Full hints give the schema outright. Partial hints overlay the inferred schema."""
    if full:
        schema = T._parse_datatype_string(hints)
    else:
        inference = {"inferSchema": "true"} if fmt == "csv" else {}
        inferred = scan_files(spark, path, fmt, **{**options, **inference}).schema
        schema = hinted_schema(inferred, hints)
    return scan_files(spark, path, fmt, schema=schema, **options)


def scan_rescued(spark: SparkSession, path: str, fmt: str, schema: str | T.StructType, **options) -> DataFrame:
    """Permissive read: a malformed record is kept whole in `_corrupt_record` and flagged."""
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    wide = T.StructType(struct.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
    df = scan_files(
        spark, path, fmt, schema=wide, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT_COLUMN, **options
    )
    return df.withColumn("has_parsing_errors", F.col(CORRUPT_COLUMN).isNotNull())


def split_rescued(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows). Works on batch and streaming frames. Write the quarantined
    rows before counting them: Spark does not count text files by the corrupt column alone."""
    clean = df.where(~F.col("has_parsing_errors")).drop(CORRUPT_COLUMN, "has_parsing_errors")
    return clean, df.where(F.col("has_parsing_errors"))


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Origin path, size and modification time of each row, from the hidden metadata column."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_size").alias("_source_file_size"),
        F.col("_metadata.file_modification_time").alias("_source_file_modified"),
    )


def list_folder(spark: SparkSession, path: str, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """Files with size and modification time. The content column is pruned, so nothing is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", F.col("length").alias("size_bytes"), "modificationTime")


def stream_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema=None,
    evolve: bool = True,
    max_files_per_trigger: int | None = None,
    **options,
) -> DataFrame:
    """Incremental discovery of new files.

    The schema is inferred once by a batch read when none is given. With `evolve` new columns in
    later files are picked up at the next restart of the stream (schema read again); without it a
    file whose values do not fit the fixed schema fails the stream.
    """
    if schema is None:
        merge = {"mergeSchema": "true"} if fmt == "parquet" and evolve else {}
        inference = {"inferSchema": "true"} if fmt == "csv" else {}
        schema = scan_files(spark, path, fmt, **{**options, **merge, **inference}).schema
    reader = spark.readStream.format(fmt).schema(schema).options(**{k: str(v) for k, v in options.items()})
    if not evolve and fmt in {"json", "csv"}:
        reader = reader.option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
