"""A stored index of vectors: inverted lists around trained centroids.

Rows lie in one folder for each list, so a search reads the folders of the lists nearest to the query and no
others. How many those are is measured when the index is built: the fewest whose recall among a sample of the
rows reaches the target. Changes rewrite the lists that they touch and leave the others as they are.

Centroids are trained on a bounded sample (SAMPLE rows, by the hash of their key); every row is assigned. Rows whose
vector is null, zero, holds null or non-finite numbers, or has another length than most are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laminae.operators.changes import table_changes
from laminae.operators.ordered import same_keys
from laminae.operators.vectors import NUM_RESULTS, cosine, dot
from laminae.session import cut_lineage
from laminae.sinks import versions

SAMPLE, MEASURED, MOST_LISTS = 20_000, 200, 4096
RECALL, DEPTH = 0.93, 10  # what is aimed at, among the ten nearest


class VectorIndex:
    def __init__(self, spark: SparkSession, path: str, key: str, vector: str):
        self.spark, self.path, self.key, self.vector = spark, path.rstrip("/"), key, vector
        rows = spark.read.parquet(f"{self.path}/centroids").orderBy("list").collect()  # at most MOST_LISTS
        self.centroids = np.array([r.centroid for r in rows], float)
        self.probes = rows[0].probes if rows else 1

    # ---- building --------------------------------------------------------------------------------

    @classmethod
    def build(cls, df: DataFrame, path: str, key: str, vector: str, lists: int | None = None, recall: float = RECALL) -> VectorIndex:
        rows = _unit(df, vector)
        width = _usable(df, vector).groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").head()
        if not width:
            raise ValueError("an index needs at least one usable vector")
        sample = cut_lineage(rows.where(F.size("_unit") == width.n).select(key, "_unit").orderBy(F.xxhash64(key), key).limit(SAMPLE), "sample")
        points = np.array([r._unit for r in sample.collect()], float)
        lists = max(1, min(lists or math.isqrt(df.count()), MOST_LISTS, len(points)))
        model = KMeans(k=lists, featuresCol="_point", seed=7, maxIter=15).fit(sample.select(array_to_vector("_unit").alias("_point")))
        centroids = np.array(model.clusterCenters())
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
        probes = _enough(points, centroids, recall)
        made = [(i, [float(x) for x in c], probes) for i, c in enumerate(centroids)]
        spark = df.sparkSession
        spark.createDataFrame(made, "list int, centroid array<double>, probes int").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
        index = cls(spark, path, key, vector)
        index._write(index.assigned(df), False)
        return index

    def assigned(self, df: DataFrame) -> DataFrame:
        """Usable rows with the list of the centroid nearest by cosine (ties: the smaller number)."""
        rows = _unit(df, self.vector).where(F.size("_unit") == self.centroids.shape[1])
        centroids, width = self.centroids, self.centroids.shape[1]

        def nearest(frames):
            for frame in frames:
                x = np.array(frame["_unit"].tolist(), float).reshape(-1, width)
                frame["list"] = (x @ centroids.T).argmax(axis=1).astype(np.int32)
                yield frame.drop(columns="_unit")

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != "list")
        return rows.drop("list").mapInPandas(nearest, f"{schema}, list int")

    def _write(self, rows: DataFrame, only_own_lists: bool) -> None:
        """One file for a list of usual size; Spark divides larger ones."""
        writer = rows.hint("rebalance", F.col("list")).write.mode("overwrite").partitionBy("list")
        writer.option("partitionOverwriteMode", "dynamic" if only_own_lists else "static").parquet(f"{self.path}/entries")

    # ---- reading ---------------------------------------------------------------------------------

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/entries")

    def nearest_lists(self, query: list[float], n: int) -> list[int]:
        q = np.array(query, float)
        return np.argsort(-(self.centroids @ (q / np.linalg.norm(q))), kind="stable")[:n].tolist()

    def probed(self, query: list[float], probes: int | None = None) -> DataFrame:
        """The entries of the lists nearest to a query: a filter on the folders."""
        return self.entries().where(F.col("list").isin(self.nearest_lists(query, probes or self.probes)))

    def search(self, query: list[float], k: int = NUM_RESULTS, probes: int | None = None, columns: list[str] | None = None) -> DataFrame:
        """The k entries most similar to the query among the probed lists, best first, ties to the smaller key. Further
        lists are probed while they hold fewer than k."""
        n = probes or self.probes
        while n < len(self.centroids) and self.probed(query, n).count() < k:
            n *= 2
        shown = columns if columns is not None else [self.key]
        scored = self.probed(query, n).withColumn("score", cosine(F.col(self.vector), query))
        return scored.orderBy(F.col("score").desc(), F.col(self.key)).limit(k).select(*shown, "score")

    def search_each(self, queries: dict[object, list[float]], k: int = NUM_RESULTS) -> DataFrame:
        """What search finds for each of a few queries, by one read of the lists that any of them probes: asked (the
        query's name), key and score."""
        held = {r.list: r["count"] for r in self.entries().groupBy("list").count().collect()}  # at most MOST_LISTS
        lists = {}
        for asked, query in queries.items():
            n = self.probes
            while n < len(self.centroids) and sum(held.get(i, 0) for i in self.nearest_lists(query, n)) < k:
                n *= 2
            lists[asked] = self.nearest_lists(query, n)
        probed = self.entries().where(F.col("list").isin(sorted({i for own in lists.values() for i in own})))
        return best_each(probed, self.key, self.vector, queries, k, lists)

    # ---- maintenance -----------------------------------------------------------------------------

    def upsert(self, rows: DataFrame) -> list[int]:
        """Rows replace entries of their key and are added otherwise; returns the lists written anew."""
        return self._apply(rows.select(self.key).distinct(), rows)

    def delete(self, keys: DataFrame) -> list[int]:
        return self._apply(keys.select(self.key).distinct(), None)

    def sync(self, source: DataFrame) -> list[int]:
        """Bring the index to the source's rows: only what changed is written."""
        now = self.entries().drop("list")
        feed = cut_lineage(table_changes(now, _usable(source, self.vector).select(*now.columns), [self.key]), "feed")
        fresh = feed.where(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
        return self._apply(feed.select(self.key).distinct(), fresh)

    def _apply(self, keys: DataFrame, rows: DataFrame | None) -> list[int]:
        keys = cut_lineage(keys, "keys").alias("k")
        same = same_keys("e", "k", [self.key])
        entries = self.entries()
        touched = entries.select(self.key, "list").alias("e").join(keys, same, "left_semi").select("list")
        fresh = cut_lineage(self.assigned(rows).select(*entries.columns), "fresh") if rows is not None else None
        if fresh is not None:
            touched = touched.unionAll(fresh.select("list"))
        lists = sorted(r.list for r in touched.distinct().collect())  # at most MOST_LISTS
        if not lists:
            return []
        kept = entries.where(F.col("list").isin(lists)).alias("e").join(keys, same, "left_anti")
        state = cut_lineage(kept.unionByName(fresh) if fresh is not None else kept, "lists")
        left = {r.list for r in state.select("list").distinct().collect()}
        self._write(state, True)
        for n in set(lists) - left:  # nothing was written for a list without rows
            versions.drop_folder(self.spark, f"{self.path}/entries/list={n}")
        return lists


def best_each(rows: DataFrame, key: str, vector: str, queries: dict[object, list[float]], k: int, lists: dict[object, list[int]] | None = None) -> DataFrame:
    """The k usable rows most similar to each of a few queries by one scan: asked, key and score, ties to the smaller
    key. With lists a query only meets the rows of its own. Tasks keep what can be among the best; only that meets."""
    names, width = list(queries), len(next(iter(queries.values())))
    q = np.array([queries[n] for n in names], float)
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    own = [np.array(lists[n]) for n in names] if lists else None
    spark, usable = rows.sparkSession, _usable(rows, vector).where(F.size(vector) == width)

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array(frame["vector"].tolist(), float).reshape(-1, width)
            # summed alike for every row, so that copies have equal scores
            scores = np.einsum("ij,kj->ik", q, x / np.linalg.norm(x, axis=1, keepdims=True))
            for i, score in enumerate(scores):
                at = np.flatnonzero(np.isin(frame["list"], own[i])) if own else np.arange(len(score))
                if len(at) > k:  # equal scores stay, as the key decides among them
                    at = at[score[at] >= np.partition(score[at], -k)[-k]]
                yield pd.DataFrame({"number": i, "key": frame["key"].to_numpy()[at], "score": score[at]})

    kind = rows.schema[key].dataType.simpleString()
    met = usable.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"), (F.col("list") if lists else F.lit(0)).alias("list"))
    found = met.mapInPandas(best, f"number int, key {kind}, score double")
    place = F.row_number().over(W.partitionBy("number").orderBy(F.desc("score"), "key"))
    best_k = found.withColumn("place", place).where(F.col("place") <= k)
    named = spark.createDataFrame(list(enumerate(names)), f"number int, asked {kind}")
    return best_k.join(F.broadcast(named), "number").select("asked", F.col("key").alias(key), "score")


def _usable(df: DataFrame, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return df.where(F.col(vector).isNotNull() & finite & F.exists(v, lambda x: x != 0))


def _unit(df: DataFrame, vector: str) -> DataFrame:
    """Usable rows with their vector scaled to length one. The length is repeated beside the numbers: inside the
    function of each number it would be computed for each of them."""
    v: Column = F.col(vector).cast("array<double>")
    size = F.sqrt(dot(v, v))
    return _usable(df, vector).withColumn("_unit", F.zip_with(v, F.array_repeat(size, F.size(v)), lambda x, s: x / s))


def _enough(points: np.ndarray, centroids: np.ndarray, recall: float) -> int:
    """The fewest lists to probe so that the nearest rows of sampled queries are found at the wanted rate."""
    queries = points[:: max(1, len(points) // MEASURED)][:MEASURED]
    home = (points @ centroids.T).argmax(axis=1)
    order = np.argsort(-(queries @ centroids.T), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(centroids))[None, :], axis=1)
    top = np.argsort(-(queries @ points.T), axis=1, kind="stable")[:, :DEPTH]
    needed = np.sort(np.take_along_axis(place, home[top], axis=1).ravel())
    return int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)))]) + 1
