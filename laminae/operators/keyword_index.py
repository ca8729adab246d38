"""A stored inverted index of words for BM25, so that a query reads the postings of its terms and no text.

Postings (term, key, tf, length) lie in folders by a hash of the term and are sorted by term and block of keys in
them: a query opens the folders of its terms and, by the statistics of the files, little else of them. For each
term and block the largest share that the term can add to a score is kept, so that the best k are found
without reading blocks that cannot hold any of them.

Words are runs of letters and digits of the whole text in lower case. Keys are unique, a null one included; a row with a
null text counts as a row, but not in the average length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminae.operators.vectors import BM25_B, BM25_K1, NUM_RESULTS
from laminae.session import cut_lineage

FOLDERS, BLOCKS, FIRST = 64, 1024, 16


def _folder(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(FOLDERS)).cast("int")


class KeywordIndex:
    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.totals = spark.read.parquet(f"{self.path}/totals").head()

    @classmethod
    def build(cls, df: DataFrame, path: str, key: str, text: str) -> KeywordIndex:
        spark, path = df.sparkSession, path.rstrip("/")
        words = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
        split = df.select(key, words.alias("words")).select(key, F.array_size("words").alias("length"), "words")
        # the words of a text are in one task: they are counted there, before anything is shuffled
        counted = split.select(key, "length", F.explode("words").alias("term")).groupBy("term", key, "length").agg(F.count(F.lit(1)).alias("tf"))
        block = F.pmod(F.xxhash64(key), F.lit(BLOCKS)).cast("int").alias("block")
        postings = counted.select(_folder(F.col("term")).alias("folder"), "term", block, key, F.col("tf").cast("int"), "length")
        placed = postings.hint("rebalance", F.col("folder")).sortWithinPartitions("folder", "term", "block")
        placed.write.mode("overwrite").partitionBy("folder").parquet(f"{path}/postings")
        split.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("avg_len")).coalesce(1).write.mode("overwrite").parquet(f"{path}/totals")
        index = cls(spark, path, key)
        stored = spark.read.parquet(f"{path}/postings")
        tops = stored.groupBy("folder", "term", "block").agg(F.max(index._share()).alias("top"), F.count(F.lit(1)).alias("n"))
        tops.hint("rebalance", F.col("folder")).sortWithinPartitions("folder", "term").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/blocks")
        return index

    def _share(self) -> Column:
        """What a posting adds to a score, before the weight of its term."""
        tf = F.col("tf").cast("double")
        norm = F.lit(BM25_K1) * (F.lit(1 - BM25_B) + F.lit(BM25_B) * F.col("length") / F.lit(float(self.totals.avg_len or 1.0)))
        return tf * F.lit(BM25_K1 + 1) / (tf + norm)

    def _of(self, table: str, terms: list[str]) -> DataFrame:
        """The rows of some terms: filters on the folders and on the sorted term."""
        folders = self.spark.createDataFrame([(t,) for t in terms], "term string").select(_folder(F.col("term")).alias("f")).distinct().collect()
        rows = self.spark.read.parquet(f"{self.path}/{table}")
        return rows.where(F.col("folder").isin([r.f for r in folders]) & F.col("term").isin(terms))

    def postings(self, terms: list[str]) -> DataFrame:
        return self._of("postings", _distinct(terms))

    def _weights(self, terms: list[str]) -> dict[str, float]:
        held = {r.term: r.n for r in self._of("blocks", terms).groupBy("term").agg(F.sum("n").alias("n")).collect()}
        return {t: math.log(1.0 + (self.totals.n - held.get(t, 0) + 0.5) / (held.get(t, 0) + 0.5)) for t in terms}

    def _scored(self, postings: DataFrame, weights: dict[str, float]) -> DataFrame:
        """Terms are added in their own order, so a score does not depend on where rows lie."""
        part = [F.coalesce(F.max(F.when(F.col("term") == t, F.lit(w) * self._share())), F.lit(0.0)) for t, w in weights.items()]
        return postings.groupBy(self.key).agg(sum(part, F.lit(0.0)).alias("keyword_score"))

    def scores(self, terms: list[str]) -> DataFrame:
        """BM25 score of every key that holds a term."""
        terms = _distinct(terms)
        return self._scored(self._of("postings", terms), self._weights(terms))

    def search(self, terms: list[str], k: int = NUM_RESULTS) -> DataFrame:
        """The k best keys, best first, ties to the smaller key. Blocks are read in order of the most that they can
        hold: some first, then those that could still beat the k-th best."""
        terms = _distinct(terms)
        weights = self._weights(terms)
        weight = F.create_map(*[x for t, w in weights.items() for x in (F.lit(t), F.lit(w))])[F.col("term")] if weights else F.lit(0.0)
        tops = self._of("blocks", terms).groupBy("block").agg(F.sum(F.col("top") * weight).alias("top"), F.max("n").alias("n"))
        blocks = sorted(tops.collect(), key=lambda r: -r.top)  # at most BLOCKS
        best = lambda chosen: self._scored(self._of("postings", terms).where(F.col("block").isin(chosen)), weights).orderBy(F.col("keyword_score").desc(), self.key).limit(k)
        start, held = 0, 0
        while start < len(blocks) and (start < FIRST or held < k):  # a block holds at least the keys of one of its terms
            held += blocks[start].n
            start += 1
        first = [r.block for r in blocks[:start]]
        found = cut_lineage(best(first), "best")  # at most k rows
        reached = found.agg(F.count(F.lit(1)).alias("n"), F.min("keyword_score").alias("least")).head()
        least = reached.least if reached.n == k else -math.inf
        # sums of maxima are rounded, so a little is left to spare; equal scores may have smaller keys
        more = [r.block for r in blocks[start:] if r.top * (1 + 1e-9) >= least]
        if not more:
            return found.orderBy(F.col("keyword_score").desc(), self.key)
        return found.unionAll(best(more)).orderBy(F.col("keyword_score").desc(), self.key).limit(k)


def _distinct(terms: list[str]) -> list[str]:
    return sorted({t.lower() for t in terms})
