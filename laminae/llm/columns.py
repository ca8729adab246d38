"""Small helpers shared by the text operators: column selection and Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = "4m"


def bound_batches(spark: SparkSession) -> None:
    """Bounds what goes to a Python worker at once by size, as texts may be long: Spark's own bound of
    10,000 rows can hold any number of bytes. A session that sets a bound of its own keeps it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.conf.get(key, None):
        spark.conf.set(key, BATCH_BYTES)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """Only the id and the text as UTF-8 bytes (null text: empty), so other columns never clash."""
    bound_batches(df.sparkSession)
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
        *[c.alias(k) for k, c in more.items()],
    )


def row_key(*cols: str) -> Column:
    """One 128-bit-wide string key of a row's columns: equal rows share it, null ids included."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols]
    return F.md5(F.concat_ws("\x01", *parts).cast("binary"))


def list_array(chunks: list[bytes], kind: pa.DataType) -> pa.ListArray:
    """A list column from packed little-endian values, one bytes object for each row."""
    width = kind.bit_width // 8
    sizes = np.fromiter(map(len, chunks), np.int64, len(chunks)) // width
    offsets = np.zeros(len(chunks) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    values = pa.Array.from_buffers(kind, int(offsets[-1]), [None, pa.py_buffer(b"".join(chunks))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def held_out(id_col: str, folds: int) -> Column:
    """True for rows whose crc32 of the id as text is divisible by folds; a null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(True))
