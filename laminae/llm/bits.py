"""A bit table of bounded size that tells which hashes may be in a large table. It never misses one."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from laminae.session import shuffles_removed

BITS = 27  # 16 MB
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _places(x: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    shift = np.uint64(64 - size)
    return x >> shift, (x * _MIX) >> shift


def build(df: DataFrame, column: str, size: int = BITS) -> bytes:
    """The table of 2 ** size bits of a long column of hashes: two bits for each. A task marks a table of its own and sends its parts on
    compressed, so that few hashes are few bytes and many no more than the table."""
    parts = 1 << 9

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << (size - 6), np.uint64)
        for batch in batches:
            places = np.unique(np.concatenate(_places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), size))).astype(np.int64)
            cell, start = np.unique(places >> 6, return_index=True)
            ones = np.uint64(1) << (places & 63).astype(np.uint64)
            if len(start):
                table[cell] |= np.bitwise_or.reduceat(ones, start)
        yield from sent(table)

    def sent(table: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = table.reshape(parts, -1)
        used = np.flatnonzero(rows.any(axis=1))
        packed = [zlib.compress(rows[i].tobytes(), 1) for i in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(packed, pa.binary())], ["part", "packed"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((parts, (1 << (size - 6)) // parts), np.uint64)
        for batch in batches:
            for i, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                table[i] |= np.frombuffer(zlib.decompress(packed), np.uint64)
        yield from sent(table.reshape(-1))

    made = "part long, packed binary"
    with shuffles_removed(df.sparkSession):
        marked = df.select(column).mapInArrow(mark, made).repartition("part").mapInArrow(merge, made).toArrow()
    table = np.zeros((parts, (1 << (size - 6)) // parts), np.uint64)
    for i, packed in zip(marked["part"].to_pylist(), marked["packed"].to_pylist()):
        table[i] = np.frombuffer(zlib.decompress(packed), np.uint64)
    return table.tobytes()


def maybe(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in the table, given as unsigned 64-bit words."""
    hit = np.ones(len(x), bool)
    for p in _places(x, (len(table) * 64).bit_length() - 1):
        hit &= (table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1
    return hit
