"""Near duplicates by the exact similarity of word shingles.

Candidates come from tiles of SimHash fingerprints (`simhash_tiles.close_pairs`): 512 bits of a text's shingles,
compared exactly within the tiles whose texts have about as many shingles, at a radius that texts of similarity 0.8
pass with probability 0.9999. Every pair is verified by the Jaccard similarity of its shingles, and only verified
pairs are linked.
Each text is first compared with its NEAREST candidates in a tile. Where there are more, their texts go on in rounds with
the nearest ones outside their own group, and when a round links less than half of its pairs, with all that are
left: a group of many copies never costs its square, and no candidate between two groups is left unverified. Only
texts that are alike by about 0.65 to 0.8 and in different groups cost all their pairs.

Defined cases: texts are compared in ASCII lower case; texts without words are all equal; fewer words than a
shingle make one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminae.llm.chains import WordHash, word_hashes
from laminae.llm.columns import bound_batches
from laminae.llm.graph import components
from laminae.llm.simhash_tiles import close_pairs, wide_fingerprint
from laminae.session import cut_lineage

SHINGLE, SIMILAR, NEAREST = 5, 0.8, 3
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: bytes, known: WordHash, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    h = word_hashes(text, known)
    size = min(size, len(h))
    out = np.zeros(max(1, len(h) - size + 1), np.uint64)
    for i in range(size):
        out = (out ^ h[i : i + len(out)]) * _MIX
        out ^= out >> np.uint64(31)
    return np.unique(out)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def groups(df: DataFrame, text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """hash, root: for each text (by text_hash) that has near duplicates the smallest hash of its group."""
    bound_batches(df.sparkSession)
    distinct = df.select(text_hash(F.col(text_col)).alias("hash"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            sets = [shingles(t.as_py(), known) for t in batch.column(1)]
            prints = pa.array([wide_fingerprint(s).tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), prints], ["hash", "size", "print"])

    prints = cut_lineage(distinct.mapInArrow(signed, "hash long, size long, print binary").dropDuplicates(["hash"]), "prints")
    rows, links, most = prints.withColumn("root", F.col("hash")), None, NEAREST
    while True:
        met = cut_lineage(close_pairs(rows, similar, most), "met")
        pairs = cut_lineage(met.filter("b IS NOT NULL").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        more = cut_lineage(_verified(distinct, pairs, similar), "links")
        links = more if links is None else links.unionAll(more)
        found = cut_lineage(components(links), "groups")
        left = met.filter("b IS NULL").select(F.col("a").alias("hash")).distinct()
        if left.isEmpty():
            return found.withColumnRenamed("node", "hash")
        if 2 * more.count() < pairs.count():
            most = None
        rows = prints.join(left, "hash", "left_semi").join(found.withColumnRenamed("node", "hash"), "hash", "left").withColumn("root", F.coalesce("root", "hash"))


def _verified(distinct: DataFrame, pairs: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b: text hashes) whose texts are similar by their shingles."""
    wanted = pairs.select(F.col("a").alias("hash")).unionAll(pairs.select(F.col("b").alias("hash"))).distinct()
    held = cut_lineage(distinct.join(wanted, "hash", "left_semi").groupBy("hash").agg(F.first("text").alias("text")), "texts")
    both = pairs.join(held.select(F.col("hash").alias("b"), F.col("text").alias("text_b")), "b").join(held.select(F.col("hash").alias("a"), F.col("text").alias("text_a")), "a")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            near = [similarity(shingles(x.as_py(), known), shingles(y.as_py(), known)) >= similar for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(verified, "a long, b long")
