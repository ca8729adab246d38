"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are sorted by the numbers of ones in their bytes and cut into tiles of equal
size. Two fingerprints within radius bits have popcounts that differ by at most radius, in total and
summed over any parts. A tile keeps the range of these counts, whole and by byte; a pair of tiles whose
ranges lie further apart than the radius is skipped. The remaining pairs are compared exactly with
exclusive-or and bit counts in numpy. A tile pair reports a spanning forest of its links, so a
family of many near copies costs as many rows as it has members and not their square.

The comparison is exact, and so its work grows with the square of the number of distinct fingerprints,
divided by what the ranges skip, which grows too, as tiles get narrower.

Sets of hashes (`close_pairs`) go the same way with fingerprints of 512 bits: tiles are sorted by the sizes of the sets,
and a pair of tiles whose sizes differ by more than the wanted similarity allows is skipped, which is exact. Links of
such fingerprints are candidates that the caller verifies, and so each row names its nearest ones instead of a
forest.

Defined cases: a text without words (null, empty, white space) has the fingerprint zero and is linked
like others; fewer words than a shingle make one shingle; equal fingerprints are linked; a null id is in
no component of its own: its component_id is that of the ids it is linked with, or null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminae.llm.columns import texts
from laminae.llm.graph import components
from laminae.session import cut_lineage

SHINGLE, SEED, RADIUS, TILE = 4, 42, 4, 4096
WIDE, MOST_TILE = 8, 65536  # 64-bit words of a wide fingerprint
_FACTORS = np.random.default_rng(42).integers(0, 2**63, (WIDE, 2), np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bit k is 1 if it is set in over half of the shingles' hashes."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    hash_ = xxhash.xxh64_intdigest
    hashes = np.array([hash_(g, SEED) for g in grams], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[i : i + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes())


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, bits (the unsigned fingerprint's bits as a long) of each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], ["doc_id", "bits"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, bits long")


def forest(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of a spanning forest of all links between two lists of fingerprints."""
    nodes = np.concatenate([left, right])
    parent, n = np.arange(len(nodes)), len(left)
    for i in range(0, n, 256):
        near = np.bitwise_count(left[i : i + 256, None] ^ right[None, :]) <= radius
        a, b = np.nonzero(near)
        a, b = a + i, b + n
        while len(a):
            pa_, pb = parent[a], parent[b]
            apart = pa_ != pb
            a, b, pa_, pb = a[apart], b[apart], pa_[apart], pb[apart]
            if not len(a):
                break
            np.minimum.at(parent, np.maximum(pa_, pb), np.minimum(pa_, pb))
            while (parent != (up := parent[parent])).any():
                parent = up
    joined = parent != np.arange(len(nodes))
    return nodes[joined], nodes[parent[joined]]


def tiles(distinct: DataFrame, size: int) -> DataFrame:
    """Tiles of sorted fingerprints: number, packed bits, and lowest and highest counts of ones."""
    spark = distinct.sparkSession
    count = F.bit_count("bits")
    parts = [F.bit_count(F.shiftrightunsigned("bits", 8 * i).bitwiseAND(F.lit(255))) for i in range(8)]
    ordered = distinct.select("bits", (parts[0] + parts[1] + parts[2] + parts[3]).alias("half"), F.concat(*[p.cast("string") for p in parts]).alias("by_byte"), count.alias("ones"))
    total = distinct.count()
    number = max(1, -(-total // size))
    order = ["ones", "half", "by_byte", "bits"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False))
            data = np.concatenate(held)
            full = len(data) - len(data) % size
            held = [data[full:]]
            if full:
                yield pack(data[:full].reshape(-1, size))
        if held and len(held[0]):
            yield pack(held[0][None, :])

    def pack(rows: np.ndarray) -> pa.RecordBatch:
        by_byte = np.bitwise_count(np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1, 8)).astype(np.int32)
        ones = by_byte.sum(axis=2, dtype=np.int32)
        packed = pa.array([r.tobytes() for r in rows], pa.binary())
        low, high = by_byte.min(axis=1), by_byte.max(axis=1)
        return pa.RecordBatch.from_arrays(
            [packed, pa.array(ones.min(axis=1)), pa.array(ones.max(axis=1)), pa.array(low.tolist(), pa.list_(pa.int32())), pa.array(high.tolist(), pa.list_(pa.int32()))],
            ["packed", "least", "most", "low", "high"],
        )

    sorted_ = ordered.repartitionByRange(number, *order).sortWithinPartitions(*order).select("bits")
    made = sorted_.mapInArrow(cut, "packed binary, least int, most int, low array<int>, high array<int>")
    return cut_lineage(made.withColumn("tile", F.monotonically_increasing_id()), "tiles") if total else spark.createDataFrame(
        [], "packed binary, least int, most int, low array<int>, high array<int>, tile long"
    )


def links(distinct: DataFrame, radius: int = RADIUS, size: int = TILE) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column bits) that connect whatever lies within radius."""
    cut = tiles(distinct, size)
    bounds = cut.select("tile", "least", "most", "low", "high")
    left = bounds.select(*[F.col(c).alias(f"{c}_a") for c in bounds.columns], F.explode(F.sequence(F.col("least") - radius, F.col("most") + radius)).alias("ones"))
    right = bounds.select(*[F.col(c).alias(f"{c}_b") for c in bounds.columns], F.explode(F.sequence("least", "most")).alias("ones"))
    gaps = F.zip_with("low_b", "high_a", lambda x, y: F.greatest(x - y, F.lit(0)))
    back = F.zip_with("low_a", "high_b", lambda x, y: F.greatest(x - y, F.lit(0)))
    apart = F.aggregate(gaps, F.lit(0), lambda s, x: s + x) + F.aggregate(back, F.lit(0), lambda s, x: s + x)
    # each unordered pair once
    pairs = left.join(right, "ones").filter((F.col("tile_a") <= F.col("tile_b")) & (apart <= radius))
    pairs = pairs.select("tile_a", "tile_b").distinct()
    both = pairs.join(cut.select(F.col("tile").alias("tile_a"), F.col("packed").alias("a")), "tile_a").join(
        cut.select(F.col("tile").alias("tile_b"), F.col("packed").alias("b")), "tile_b"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column(0), batch.column(1)):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                a, b = forest(x, y, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    spread = both.select("a", "b").repartition(max(8, int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return spread.mapInArrow(compare, "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, shingle: int = SHINGLE, tile: int = TILE) -> DataFrame:
    """doc_id, bits and component_id, the smallest id that links reach, for each row."""
    prints = cut_lineage(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    distinct = prints.groupBy("bits").agg(F.min("doc_id").alias("low"))
    roots = components(links(distinct.select("bits"), radius, tile)).withColumnRenamed("node", "bits")
    classed = cut_lineage(distinct.join(roots, "bits", "left").select("bits", "low", F.coalesce("root", "bits").alias("root")), "classes")
    lowest = classed.groupBy("root").agg(F.min("low").alias("component_id"))
    of_bits = cut_lineage(classed.join(lowest, "root").select("bits", "component_id"), "components")
    return prints.join(of_bits, "bits").select("doc_id", "bits", "component_id")


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """A SimHash of WIDE words of a set of hashes: a bit is 1 if it is set in over half of them, mixed anew for each word."""
    ones = np.zeros(64 * WIDE, np.int64)
    for i in range(0, len(hashes), 4096):
        mixed = hashes[i : i + 4096, None] * _FACTORS[:, 0] + _FACTORS[:, 1]
        for _ in range(2):
            mixed ^= mixed >> np.uint64(32)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        ones += np.unpackbits(mixed.view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes)).view(np.uint64)


def wide_radius(size: np.ndarray, similar: float) -> tuple[np.ndarray, int]:
    """Bits by which the fingerprints of sets of this Jaccard similarity differ at most, and those of the first word.

    Two sets of cosine c differ in arccos(c) / pi of the bits, up to a quarter more in sets of a few hashes, where
    halves are often ties; four (five) standard deviations are added."""
    share = np.arccos(2 * similar / (1 + similar)) / np.pi
    bound = lambda q, n, z: q * n + z * np.sqrt(q * (1 - q) * n)
    return np.where(size < 16, bound(1.25 * share, 64 * WIDE, 4), bound(share, 64 * WIDE, 4)).astype(np.int64), int(bound(1.25 * share, 64, 4.5))


def near_in_tiles(left: np.ndarray, right: np.ndarray, same: bool, similar: float, most: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows (hash, root, size, fingerprint words) of two tiles sorted by size that may be similar and have different
    roots: each left row's `most` nearest (None: all), and the rows of those pairs that are left out for that."""
    low, high = similar - 1e-9, 1 / (similar - 1e-9)
    at = 0
    while at < len(left):
        size = left[at, 2]
        first, last = np.searchsorted(right[:, 2], [np.uint64(np.ceil(size * low)), np.uint64(np.floor(left[min(len(left), at + 256) - 1, 2] * high)) + np.uint64(1)])
        step = int(min(256, max(1, (1 << 22) // max(1, last - first))))
        x, y = left[at : at + step], right[first:last]
        radius, radius_1 = wide_radius(x[:, 2], similar)
        i, j = np.nonzero(np.bitwise_count(x[:, None, 3] ^ y[None, :, 3]) <= radius_1)
        fits = x[i, 1] != y[j, 1]
        if same:
            fits &= at + i < first + j
        i, j = i[fits], j[fits]
        a, b = x[i, 2].astype(float), y[j, 2].astype(float)
        fits = np.minimum(a, b) >= low * np.maximum(a, b)
        i, j = i[fits], j[fits]
        bits = np.zeros(len(i), np.int64)
        for c in range(3, 3 + WIDE):
            bits += np.bitwise_count(x[i, c] ^ y[j, c])
            if c % 3 == 0:  # most pairs are far apart after a few words
                fits = bits <= radius[i]
                i, j, bits = i[fits], j[fits], bits[fits]
        fits = bits <= radius[i]
        i, j, bits = i[fits], j[fits], bits[fits]
        left_out = np.zeros(0, np.uint64)
        if most is not None and len(i):
            order = np.lexsort((bits, i))
            i, j = i[order], j[order]
            start = np.append(0, np.flatnonzero(np.diff(i)) + 1)
            place = np.arange(len(i)) - np.repeat(start, np.diff(np.append(start, len(i))))
            over = place >= most
            left_out = np.unique(np.concatenate([x[i[over], 0], y[j[over], 0]]))
            i, j = i[~over], j[~over]
        if len(i):
            yield x[i, 0], y[j, 0], left_out
        at += step


def close_pairs(prints: DataFrame, similar: float, most: int | None, tile: int | None = None) -> DataFrame:
    """Candidates (a, b) among rows (hash, root, size, print: wide fingerprint) of different roots, each row's
    `most` nearest in each tile (None: all); a row that has more is listed with a null b, as is its partner."""
    spark = prints.sparkSession
    total = prints.count()
    size_ = tile or min(MOST_TILE, max(TILE, total // 24))  # large tiles are sent out less often
    order = ["size", "hash"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3 + WIDE), np.uint64)
        for batch in batches:
            rows = np.empty((batch.num_rows, 3 + WIDE), np.uint64)
            for c in range(3):
                rows[:, c] = batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64)
            rows[:, 3:] = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint64).reshape(-1, WIDE)
            held = np.concatenate([held, rows])
            while len(held) >= size_:
                yield pack(held[:size_])
                held = held[size_:]
        if len(held):
            yield pack(held)

    def pack(rows: np.ndarray) -> pa.RecordBatch:
        ends = [pa.array([int(rows[k, 2])], pa.int64()) for k in (0, -1)]
        return pa.RecordBatch.from_arrays([pa.array([rows.tobytes()], pa.binary()), *ends], ["packed", "least", "greatest"])

    sorted_ = prints.select("hash", "root", "size", "print").repartitionByRange(max(1, -(-total // size_)), *order).sortWithinPartitions(*order)
    made = sorted_.mapInArrow(cut, "packed binary, least long, greatest long")
    tiles_ = cut_lineage(made.withColumn("tile", F.monotonically_increasing_id()), "tiles")
    ends = lambda c: tiles_.select(F.col("tile").alias(f"tile_{c}"), F.col("least").alias(f"least_{c}"), F.col("greatest").alias(f"greatest_{c}"))
    # tiles are numbered in order of size
    pairs = ends("a").join(ends("b"), (F.col("tile_a") <= F.col("tile_b")) & (F.col("least_b") * (similar - 1e-9) <= F.col("greatest_a")))
    pairs = cut_lineage(pairs.select("tile_a", "tile_b"), "tile-pairs")
    sides = [pairs.select("tile_a", "tile_b", F.lit(k).alias("side"), F.col(c).alias("tile")) for k, c in enumerate(("tile_a", "tile_b"))]
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent = sides[0].unionAll(sides[1]).join(tiles_.select("tile", "packed"), "tile").select("tile_a", "tile_b", "side", "packed")
    met = sent.repartition(n, "tile_a", "tile_b").sortWithinPartitions("tile_a", "tile_b", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            for a, b, side, packed in zip(*(batch.column(c).to_pylist() for c in range(4))):
                rows = np.frombuffer(packed, np.uint64).reshape(-1, 3 + WIDE)
                if side == 0:
                    left = rows
                    continue
                for x, y, over in near_in_tiles(left, rows, a == b, similar, most):
                    both = [pa.array(np.concatenate([x, over]).view(np.int64)), pa.array(np.append(y, over).view(np.int64), mask=np.arange(len(y) + len(over)) >= len(y))]
                    yield pa.RecordBatch.from_arrays(both, ["a", "b"])

    return met.mapInArrow(compare, "a long, b long")
