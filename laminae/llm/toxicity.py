"""Toxicity classifier: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once: words, word pairs, pairs with one or two words left out, and
the first four and five letters of each word, by which inflected forms share a feature. They are
hashed into 2^bits places. FTRL-proximal keeps a learning rate for each coordinate and an L1 penalty
that leaves most weights at exactly zero, so what is shipped to the tasks that score is a short list
of places and weights. Its size never exceeds 2^bits entries.

Learning takes a bounded sample of the labelled rows: at most sample ids of each label, those with
the smallest hash, and one text of each. Features are made where the rows are; one task then sees the sampled
rows' places, kept as compressed gaps and unpacked row by row. Scoring covers every row and is one
pass without a shuffle.

Defined cases: null and empty texts have only the constant feature, so their score is the learned
base rate; labels that are null or other than 0 and 1 are not learned from; without any label the
score is 0.5; repeated rows are scored alike; null ids are scored and never learned from.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import compress, crc32, decompress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laminae.llm.columns import bound_batches

BITS, SAMPLE = 20, 6000
_WORD = re.compile(r"\w+").findall
_REMEMBER = 300_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Features(dict):
    """Places of a text's features. As a dict it maps a word to its row of word-level hashes."""

    def __init__(self, bits: int):
        super().__init__()
        self.bits, self.used, self.table, self.letters = np.uint64(64 - bits), 0, np.zeros((1024, 3), np.uint64), 0

    def __missing__(self, word: str) -> int:
        if self.used == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        row = [crc32(x.encode("utf-8", "replace")) | kind << 32 for kind, x in ((1, word), (2, word[:4]), (3, word[:5]))]
        self.table[self.used] = row
        self[word] = self.used
        self.letters += len(word)
        self.used += 1
        return self.used - 1

    def of(self, text: str) -> np.ndarray:
        """Sorted distinct places; place 0 is the constant."""
        if len(self) > _REMEMBER or self.letters > 20 * _REMEMBER:  # long words count by their letters
            self.clear()
            self.used = self.letters = 0
        words = _WORD(text.lower())
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        single = self.table[rows]
        w = single[:, 0]
        parts = [single.ravel()]
        for gap in (1, 2, 3):
            if len(w) > gap:
                parts.append((w[:-gap] * np.uint64(31) + np.uint64(gap)) * _MIX + w[gap:])
        places = (np.concatenate(parts) * _MIX) >> self.bits
        return np.unique(np.append(places, np.uint64(0))).astype(np.int32)


def pack(places: np.ndarray) -> bytes:
    """Sorted places as compressed gaps, the bytes of equal weight together."""
    gaps = np.diff(places, prepend=0).astype("<u4")
    return compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    gaps = np.frombuffer(decompress(packed), np.uint8).reshape(4, -1).T
    return np.cumsum(np.ascontiguousarray(gaps).view("<u4").ravel(), dtype=np.int64).astype(np.int32)


@dataclass(frozen=True)
class Ftrl:
    """Settings of the learner."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 1.0
    epochs: int = 5


def fit(rows: list, labels: list[int], bits: int = BITS, set_: Ftrl = Ftrl(), read: Callable = unpack) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights that are not zero. A step touches only the places of its row, which read gives."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(x: np.ndarray) -> np.ndarray:
        zx = z[x]
        rate = (set_.beta + np.sqrt(n[x])) / set_.alpha + set_.l2
        return np.where(np.abs(zx) <= set_.l1, 0.0, (np.sign(zx) * set_.l1 - zx) / rate)

    for _ in range(set_.epochs):
        for row, y in zip(rows, labels):
            x = read(row)
            w = weights(x)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            sigma = (np.sqrt(n[x] + g * g) - np.sqrt(n[x])) / set_.alpha
            z[x] += g - sigma * w
            n[x] += g * g
    w = weights(np.arange(1 << bits))
    places = np.flatnonzero(w)
    return places.astype(np.int32), w[places]


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          bits: int = BITS, sample: int = SAMPLE, settings: Ftrl = Ftrl()) -> tuple[np.ndarray, np.ndarray]:
    """Learns from at most sample rows of each label; returns places and weights. An id with both labels
    counts as 1."""
    bound_batches(df.sparkSession)
    ids = df.select(F.col(id_col).cast("long").alias("doc_id")).filter("doc_id IS NOT NULL")
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = marks.filter("label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")).join(ids, "doc_id", "left_semi")
    part = lambda label: known.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = F.broadcast(part(0).unionAll(part(1)))  # at most two samples of ids
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    picked = rows.join(chosen, "doc_id").select("doc_id", "text", "label")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Features(bits)
        for batch in batches:
            x = [pack(of.of(t)) for t in batch.column(1).to_pylist()]
            names = ["doc_id", "label", "places"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.binary())], names)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(crc32(str(i).encode()), i, x, y) for batch in batches for i, y, x in zip(*(c.to_pylist() for c in batch.columns))]
        if rows:
            rows.sort()
            at, weight = fit([r[2] for r in rows], [r[3] for r in rows], bits, settings)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(weight, pa.float64())], ["place", "weight"])

    made = picked.mapInArrow(places, "doc_id long, label int, places binary")
    # one text for each id, however many rows repeat it: two bounded samples
    made = made.groupBy("doc_id").agg(F.first("label").alias("label"), F.min("places").alias("places")).repartition(1)
    table = made.mapInArrow(learn, "place int, weight double").toPandas()
    return table["place"].to_numpy(np.int32), table["weight"].to_numpy(np.float64)


def score(model: tuple[np.ndarray, np.ndarray], text: Column, bits: int = BITS) -> Column:
    """Probability of label 1 for a text column."""
    place, weight = model

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense = np.zeros(1 << bits)
        dense[place] = weight
        of = Features(bits)
        for batch in batches:
            logits = np.array([dense[of.of(t or "")].sum() for t in batch], dtype=np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -35, 35))))

    return probability(text)
