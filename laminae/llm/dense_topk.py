"""Exact top-k search by inner product, term at a time.

Every component of a vector is a term with a whole-number weight; rows are dealt into shards of bounded size,
each with the postings (row, weight) of its terms. A query's non-zero terms are taken one after another: each
scatters its weight times the postings' weights into a dense array with one score for each row of the
shard. A partial sort selects the shard's best k, and the shards' best are merged. Every row of every shard is
scored. Queries come in blocks, so a task's work is a block against a shard.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do rows with a null
id; zero and empty vectors do. Vectors may differ in length: a term that one of them lacks adds nothing. Rows
under a query's own id are not its candidates; every other row is one, repeated rows each on their own. Equal
query rows are answered once, rows of one id with different vectors each. Ties go to the smaller id. Fewer
candidates than k are all returned. A weight or score that does not fit a long raises an error. Extra
columns are not looked at, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHARD, BLOCK = 256, 16_384, 8_192
_LONG = 2**63


class Postings:
    """Rows and weights of each term of one shard's vectors."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray]):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        sizes = np.fromiter((len(v) for v in vectors), np.int64, len(vectors))
        weights = np.concatenate([*vectors, np.zeros(0, np.int64)])
        term = np.arange(len(weights)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        row = np.repeat(place, sizes)
        some = weights != 0
        term, row, weights = term[some], row[some], weights[some]
        by_term = np.lexsort((row, term))
        self.rows, self.weights = row[by_term], weights[by_term]
        self.starts = np.searchsorted(term[by_term], np.arange(int(sizes.max(initial=0)) + 1))
        self.heaviest = int(np.abs(weights).max(initial=0))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """The query's inner product with every row."""
        if float(np.abs(query).astype(float).sum()) * self.heaviest >= _LONG:
            raise OverflowError("scores do not fit a long")
        found = np.zeros(len(self.ids), np.int64)
        for term in np.flatnonzero(query[: len(self.starts) - 1]).tolist():
            part = slice(self.starts[term], self.starts[term + 1])
            found[self.rows[part]] += query[term] * self.weights[part]  # a row has a term once
        return found

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, without those under the query's own id, best first."""
        lo, hi = np.searchsorted(self.ids, query_id, "left"), np.searchsorted(self.ids, query_id, "right")
        scores = self.scores(query)
        ids, scores = np.delete(self.ids, slice(lo, hi)), np.delete(scores, slice(lo, hi))
        if len(ids) > k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            above = np.flatnonzero(scores > least)
            ties = np.flatnonzero(scores == least)[: k - len(above)]  # rows are in order of id
            chosen = np.concatenate([above, ties])
            ids, scores = ids[chosen], scores[chosen]
        order = np.lexsort((ids, -scores))
        return ids[order], scores[order]


def weighted(df: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """id and whole-number weights (floor of scale times the component) of the rows that take part."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    kept = rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & finite)
    fits = lambda v: F.abs(v * scale) < float(_LONG)
    checked = lambda v: F.when(fits(v), F.floor(v * scale)).otherwise(F.raise_error(F.lit("a weight does not fit a long")).cast("long"))
    return kept.select("id", F.transform("vec", checked).alias("vec"))


def search(queries: DataFrame, rows: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """query_id, rank, id, score: for each query row the k rows of largest inner product of the weights."""
    asked, stored = weighted(queries, id_col, vec_col, scale).distinct(), weighted(rows, id_col, vec_col, scale)
    shards = max(1, -(-stored.count() // shard))
    blocks = max(1, -(-asked.count() // block))
    spark = rows.sparkSession
    key = F.xxhash64("id", "vec")
    # equal rows are dealt out too: where a row lies has no bearing on the result
    own_shard = F.pmod(F.xxhash64("id", "vec", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select(everywhere(shards).alias("shard"), F.pmod(key, F.lit(blocks)).cast("int").alias("block"), F.lit(1).alias("kind"), "id", key.alias("query"), "vec")
    right = stored.select(own_shard.alias("shard"), everywhere(blocks).alias("block"), F.lit(0).alias("kind"), "id", F.lit(0).cast("long").alias("query"), "vec")
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards * blocks)
    met = right.unionAll(left).repartition(spread, "shard", "block").sortWithinPartitions("shard", "block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, vectors, postings = None, [], [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if hi == lo:
                    continue
                part, (s, b, kind) = batch.slice(lo, hi - lo), keys[:, lo].tolist()
                if (s, b) != group:
                    group, ids, vectors, postings = (s, b), [], [], None
                own, name = part.column(3).to_numpy(), part.column(4).to_pylist()
                vecs = [v.values.to_numpy() for v in part.column(5)]
                if kind == 0:
                    ids.append(own)
                    vectors += vecs
                    continue
                if not ids:
                    continue
                if postings is None:
                    postings, vectors = Postings(np.concatenate(ids), vectors), []
                found = [postings.best(int(i), v, k) for i, v in zip(own, vecs)]
                sizes = [len(f[0]) for f in found]
                columns = [np.repeat(own, sizes), np.repeat(np.array(name, np.int64), sizes), *(np.concatenate([f[c] for f in found]) for c in (0, 1))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "query", "id", "score"])

    best = met.mapInArrow(run, "query_id long, query long, id long, score long")
    # at most k rows for each query and shard; all but the best k of these go in the map tasks
    ranked = best.selectExpr("query_id", "id", "score", "row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, id) AS rank")
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
