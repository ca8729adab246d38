"""Approximate nearest neighbours by a forest of hash prefixes.

Each tree gives every vector a long string of hash bits, the signs of its products with random
directions, and keeps the strings as one sorted array. A query descends in all trees at once to the
longest prefix that any string shares with it, then ascends in all of them together, one bit at a
time, until the vectors met so far reach the wanted number. Those are scored exactly.

The rows are dealt at random into shards of bounded size, each with its own forest, and every query is
answered by every shard; the shards' best are merged. Each shard holds a bounded number of rows, so its
sorted arrays fit a task's memory whatever the table's size. A shard is sent to one task and its forest built
once there; the queries come to it in blocks. Only vectors that a query met are scored for it.

Vectors that are null, all zero, or hold null or non-finite components take no part, neither do rows
with a null id or, for a query, candidates under its own id. Vectors of another length than the most
common one raise an error. Ties go to the smaller id; equal vectors always score equally. Fewer
candidates than k are all returned. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TREES, DEPTH, SHARE, SHARD, BLOCK = 128, 24, 0.4, 16_384, 1024


def directions(trees: int, depth: int, width: int, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, trees * depth)).astype(np.float32)


def strings(x: np.ndarray, planes: np.ndarray, trees: int) -> np.ndarray:
    """Hash strings as numbers, one row for each tree."""
    depth = planes.shape[1] // trees
    out = np.zeros((trees, len(x)), np.uint32)
    weights = (1 << np.arange(depth - 1, -1, -1)).astype(np.uint32)
    for t in range(trees):
        out[t] = ((x @ planes[:, t * depth : (t + 1) * depth]) > 0) @ weights
    return out


class Forest:
    """Sorted arrays over one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, trees: int = TREES, depth: int = DEPTH):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x, self.trees, self.depth, self.scored = ids[order], x[order], trees, depth, 0
        self.planes = directions(trees, depth, x.shape[1])
        keys = strings(self.x.astype(np.float32), self.planes, trees)
        self.order = np.argsort(keys, axis=1, kind="stable").astype(np.int32)
        self.keys = np.take_along_axis(keys, self.order, axis=1)

    def ranges(self, keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each tree's strings share a prefix of this length with the queries' strings."""
        drop = self.depth - level
        low = (keys >> drop << drop).astype(np.uint32)
        high = low + np.uint32((1 << drop) - 1)
        lo = np.stack([np.searchsorted(a, k, "left") for a, k in zip(self.keys, low)])
        hi = np.stack([np.searchsorted(a, k, "right") for a, k in zip(self.keys, high)])
        return lo, hi

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, share: float) -> Iterator[tuple[int, int, float]]:
        """The k best (query, id, score) of each query among at least share of the shard's vectors."""
        keys = strings(q.astype(np.float32), self.planes, self.trees)
        wanted = min(len(self.ids), max(4 * k, int(np.ceil(share * len(self.ids)))))
        met = np.zeros((len(q), len(self.ids)), bool)
        open_ = np.arange(len(q))
        for level in range(self.depth, -1, -1):  # from the longest prefixes upwards, in all trees at once
            lo, hi = self.ranges(keys[:, open_], level)
            # ranges hold those of longer prefixes, so nothing need be marked while all trees' ranges are too few
            ready = np.flatnonzero((hi - lo).sum(axis=0) >= wanted)
            for j in ready:
                i, parts = open_[j], [a[x:y] for a, x, y in zip(self.order, lo[:, j].tolist(), hi[:, j].tolist()) if y > x]
                met[i, np.concatenate(parts)] = True
            done = ready[met[open_[ready]].sum(axis=1) >= wanted]
            open_ = np.delete(open_, done)
            if not len(open_):
                break
        met &= query_ids[:, None] != self.ids[None, :]
        for i, own in enumerate(met):
            found = np.flatnonzero(own)
            self.scored += len(found)
            near = self.x[found] @ q[i]
            if len(found) > k:
                worst = np.partition(near, len(found) - k)[len(found) - k]
                found = found[near >= worst - 1e-9 * (1 + abs(worst))]
            exact = (self.x[found] * q[i]).sum(axis=1)  # row by row in one order, so equal vectors tie
            for j in np.lexsort((self.ids[found], -exact))[:k]:
                yield int(query_ids[i]), int(self.ids[found[j]]), float(exact[j])


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda v: v != 0))


def search(queries: DataFrame, rows: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", trees: int = TREES, depth: int = DEPTH, share: float = SHARE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, id, score: for each query the k rows of largest inner product that were met."""
    queries, rows = usable(queries, id_col, vec_col), usable(rows, id_col, vec_col)
    n_rows, n_queries = rows.count(), queries.count()
    shards, blocks = max(1, -(-n_rows // shard)), max(1, -(-n_queries // block))
    stored = rows.select(F.pmod(F.xxhash64("id", "vec"), F.lit(shards)).cast("int").alias("shard"), "id", "vec")
    asked = queries.select(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int").alias("block"), "id", "vec")
    packed = F.struct("id", "vec")
    # one row for each shard, and one for each block of queries and shard, all of bounded size
    blocks_ = asked.groupBy("block").agg(F.collect_list(packed).alias("rows"))
    left = blocks_.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), (F.col("block") + 1).alias("block"), "rows")
    right = stored.groupBy("shard").agg(F.collect_list(packed).alias("rows")).select("shard", F.lit(0).alias("block"), "rows")
    spread = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(shards, 4096))
    met = right.unionAll(left).repartition(spread, "shard").sortWithinPartitions("shard", "block")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, forest = None, None
        for frame in frames:
            for number, kind, held in zip(frame["shard"], frame["block"], frame["rows"]):
                if kind == 0:
                    at, forest = number, Forest(*unpack(held), trees, depth)
                elif number == at:
                    found = list(forest.search(*unpack(held), k, share))
                    yield pd.DataFrame(found, columns=["query_id", "id", "score"])

    best = met.mapInPandas(run, "query_id long, id long, score double")
    # the shards' best of one query are at most k for each shard; the smallest of them are cut in the map tasks
    ranked = best.selectExpr("query_id", "id", "score", "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank")
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def unpack(cells) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array([c["id"] for c in cells], np.int64)
    return ids, np.array([np.asarray(c["vec"], np.float64) for c in cells])
