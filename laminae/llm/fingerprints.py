"""Document fingerprints by SimHash, and the search for near ones by permuted block tables.

Terms are the words of the text in ASCII lower case and its pairs of neighbouring words; in short texts
also runs of three bytes. A pair votes with a fixed weight, a word with one that grows with its
length, since short words are common ones; each is multiplied by the number of binary digits of the
term's count, so a term repeated very often does not outvote all others. The 256 signed sums give the
fingerprint. Weights are whole numbers, so sums are exact and equal texts have equal fingerprints.

Two fingerprints that differ in at most radius bits agree on at least one of radius + 1 blocks.
Each block in turn is the key of a table; rows that share a key are compared in full, and a pair is
counted only in the first table that holds it.

Defined cases: null and empty texts have no terms and the fingerprint zero; a null id sorts after all
others in `with_next`; rows that share an id follow each other by text; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, RADIUS = 256, 7
PAIR_WEIGHT, LETTERS_WEIGHT, SHORT = 32, 16, 40
_LAST = 2**63 - 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LANES = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


class Words(dict):
    """Hash and weight of each word, remembered."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) > 300_000:
            self.clear()
        self[word] = found = (xxhash.xxh64_intdigest(word, 9), max(1, (min(len(word), 10) - 2) ** 2))
        return found


def spread(hashes: np.ndarray) -> np.ndarray:
    """Four independent 64-bit lanes of each hash, as rows of 32 bytes."""
    x = hashes[:, None] * _LANES
    x ^= x >> np.uint64(29)
    x *= _MIX
    x ^= x >> np.uint64(32)
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(hashes), BITS // 8)


def fingerprint(text: bytes, words: Words) -> bytes:
    text = text.lower()
    parts = text.split()
    if not parts:
        return bytes(BITS // 8)
    found = np.array(list(map(words.__getitem__, parts)), np.uint64)
    h = found[:, 0]
    hashes = np.concatenate([h, h[:-1] * np.uint64(31) + h[1:]])
    weights = np.concatenate([found[:, 1], np.full(len(h) - 1, PAIR_WEIGHT, np.uint64)])
    if len(parts) < SHORT:
        letters = b" ".join(parts)
        grams = [xxhash.xxh64_intdigest(letters[i : i + 3], 8) for i in range(max(1, len(letters) - 2))]
        hashes = np.concatenate([hashes, np.array(grams, np.uint64)])
        weights = np.concatenate([weights, np.full(len(grams), LETTERS_WEIGHT, np.uint64)])
    hashes, first, count = np.unique(hashes, return_index=True, return_counts=True)
    weights = (weights[first] * (1 + np.log2(count).astype(np.uint64))).astype(np.float32)
    votes = np.zeros(BITS, np.float64)
    for i in range(0, len(hashes), 4096):  # so few that single precision is exact
        votes += weights[i : i + 4096] @ np.unpackbits(spread(hashes[i : i + 4096]), axis=1).astype(np.float32)
    return np.packbits(2 * votes > weights.sum(dtype=np.float64)).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The cosine that the share of differing bits estimates, from 0 to 1."""
    differing = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    return max(0.0, float(np.cos(np.pi * differing / (8 * len(a)))))


def with_next(
    df: DataFrame,
    fn: Callable[[int | None, str, str], tuple],
    schema: pa.Schema,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_bucket: int = 2000,
    max_buckets: int = 10_000,
) -> DataFrame:
    """fn(doc_id, text, next text) for each row in ascending id order; after the last comes the first.

    Rows go to buckets of consecutive ids by one shuffle and are sorted there. The first row of each
    bucket also goes to the bucket before it, where it only serves as the next row. Borders come from
    the ids alone; the driver holds one id for each bucket, max_buckets at most."""
    ids = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("k"))
    total = ids.count()
    share = min(max_buckets, max(1, -(-total // rows_per_bucket)))
    edges = np.array([], np.int64)
    if share > 1:
        parts = [i / share for i in range(1, share)]
        edges = np.unique(np.array(ids.agg(F.percentile_approx("k", parts, 20 * share)).first()[0], np.int64))

    @F.pandas_udf("int")
    def bucket_of(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, k.to_numpy(), "right"), dtype="int32")

    firsts = {r["b"]: r["k"] for r in ids.groupBy(bucket_of("k").alias("b")).agg(F.min("k").alias("k")).collect()}
    filled = sorted(firsts)
    ahead_of = {firsts[b]: filled[i - 1] for i, b in enumerate(filled)}

    @F.pandas_udf("array<int>")
    def buckets_of(k: pd.Series) -> pd.Series:
        own = np.searchsorted(edges, k.to_numpy(), "right").tolist()
        return pd.Series([[b, ahead_of[x]] if x in ahead_of else [b] for b, x in zip(own, k.tolist())])

    placed = df.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("k"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).select(F.posexplode(buckets_of("k")).alias("ahead", "bucket"), "k", "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bucket = None
        for batch in batches:
            out = []
            for b, ahead, doc, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held is not None and b == bucket:
                    out.append(fn(*held, text))
                held, bucket = None if ahead else (doc, text), b
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double", pa.binary(): "binary"}
    return (
        placed.repartition(max(1, len(filled)), "bucket")
        .sortWithinPartitions("bucket", "ahead", "k", "text")
        .select("bucket", "ahead", "doc_id", "text")
        .mapInArrow(run, ", ".join(f"{f.name} {kinds[f.type]}" for f in schema))
    )


EDITED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited", pa.string()),
        ("fingerprint", pa.binary()),
        ("edited_fingerprint", pa.binary()),
        ("next_fingerprint", pa.binary()),
    ]
)


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the next text's first, or all of them."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next text; edited is a sha256."""
    from hashlib import sha256

    words, last = Words(), {}

    def of(text: str) -> bytes:
        if text not in last:
            last.clear()
            last[text] = fingerprint(text.encode("utf-8", "replace"), words)
        return last[text]

    def row(doc: int | None, text: str, following: str) -> tuple:
        edited = edited_text(text, following)
        own, changed = of(text), fingerprint(edited.encode("utf-8", "replace"), words)
        return doc, len(text), sha256(edited.encode("utf-8", "replace")).hexdigest(), own, changed, of(following)

    return with_next(df, row, EDITED, id_col, text_col)


def compare(prints: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Adds the likeness of two fingerprint columns."""

    @F.pandas_udf("double")
    def liken(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) for x, y in zip(a, b)], dtype="float64")

    return prints.withColumn(name, liken(left, right))


def near(prints: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For each distinct fingerprint of queries: n_near, the rows of prints within radius bits of it, and
    near_id, the smallest doc_id among them. Both inputs hold doc_id and fingerprint (32 bytes).

    Equal fingerprints are one entry of a table, with their number of rows."""
    width = BITS // (radius + 1)
    if width * (radius + 1) != BITS or width % 8:
        raise ValueError("radius + 1 blocks of whole bytes must make up the fingerprint")
    step = width // 8
    blocks = lambda c: [F.substring(c, 1 + i * step, step) for i in range(radius + 1)]
    table = lambda d, c: d.select("*", F.posexplode(F.array(*blocks(c))).alias("block", "key"))
    stored = table(prints.groupBy("fingerprint").agg(F.count("*").alias("rows"), F.min("doc_id").alias("low")), "fingerprint")
    asked = table(queries.select(F.col("fingerprint").alias("asked")).distinct(), "asked")
    lane = lambda c, i: F.conv(F.hex(F.substring(c, 1 + 8 * i, 8)), 16, -10).cast("long")
    differing = sum((F.bit_count(lane("asked", i).bitwiseXOR(lane("fingerprint", i))) for i in range(BITS // 64)), F.lit(0))
    earlier = F.lit(False)
    for i, (a, b) in enumerate(zip(blocks("asked"), blocks("fingerprint"))):
        earlier = earlier | ((F.lit(i) < F.col("block")) & (a == b))
    pairs = asked.join(stored, ["block", "key"]).filter((differing <= radius) & ~earlier)
    return pairs.groupBy("asked").agg(F.sum("rows").alias("n_near"), F.min("low").alias("near_id"))
