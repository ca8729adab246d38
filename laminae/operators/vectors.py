"""Nearest-vector search over an array column, with cosine similarity."""

from __future__ import annotations

import math

from pyspark.ml.feature import BucketedRandomProjectionLSH, Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laminae.operators.changes import table_changes
from laminae.operators.ordered import same_keys
from laminae.session import cut_lineage

# Default result size and the rank constant of reciprocal rank fusion.
NUM_RESULTS = 5
RRF_CONSTANT = 60
BM25_K1, BM25_B = 1.2, 0.75


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(vector: Column, query: list[float]) -> Column:
    """Similarity with a literal query vector. The norm of the query is folded in beforehand."""
    q = [float(x) for x in query]
    size = sum(x * x for x in q) ** 0.5
    literal = F.array(*[F.lit(x) for x in q])
    return dot(vector, literal) / (F.sqrt(dot(vector, vector)) * F.lit(size))


def _filtered(df: DataFrame, filters: dict | str | None) -> DataFrame:
    if not filters:
        return df
    if isinstance(filters, str):
        return df.where(F.expr(filters))
    for column, wanted in filters.items():
        df = df.where(F.col(column).isin(wanted) if isinstance(wanted, (list, tuple)) else F.col(column) == wanted)
    return df


def topk(
    df: DataFrame,
    vector: str,
    query: list[float] | None,
    key: str,
    k: int = NUM_RESULTS,
    columns: list[str] | None = None,
    filters: dict | str | None = None,
) -> DataFrame:
    """Exact nearest rows, score last. Every task keeps its best k; only those meet at the end."""
    if not query:
        raise ValueError("a query vector is required")
    shown = columns if columns is not None else [key]
    scored = _filtered(df, filters).withColumn("score", cosine(F.col(vector), query))
    return scored.orderBy(F.col("score").desc(), F.col(key)).limit(k).select(*shown, "score")


def ann(df: DataFrame, vector: str, query: list[float], key: str, k: int = NUM_RESULTS, tables: int = 8, width: float = 2.0, seed: int = 7) -> DataFrame:
    """Approximate search by random projections on unit vectors, whose Euclidean order is the
    cosine order. Candidates are re-scored exactly; there are k of them unless the table has fewer rows."""
    if not query:
        raise ValueError("a query vector is required")
    unit = Normalizer(inputCol="_raw", outputCol="_unit").transform(df.withColumn("_raw", array_to_vector(F.col(vector))))
    size = sum(float(x) ** 2 for x in query) ** 0.5
    target = Vectors.dense([float(x) / size for x in query])
    wanted = min(k, unit.count())
    for wider in (1, 2, 4):
        lsh = BucketedRandomProjectionLSH(inputCol="_unit", outputCol="_hashes", numHashTables=tables, bucketLength=width * wider, seed=seed)
        near = lsh.fit(unit).approxNearestNeighbors(unit, target, k)
        found = cut_lineage(near.select(key, cosine(F.col(vector), query).alias("score")), "ann")  # at most k rows
        if found.count() >= wanted:
            return found.orderBy(F.col("score").desc(), F.col(key))
    # rows that lie opposite the query in every table share no bucket of any width
    return topk(df, vector, query, key, k, columns=[key])


def upsert(index: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows replace entries of the same key and are added otherwise."""
    kept = index.alias("i").join(rows.select(*keys).distinct().alias("r"), same_keys("i", "r", keys), "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def delete(index: DataFrame, keys_gone: DataFrame, keys: list[str]) -> DataFrame:
    gone = keys_gone.select(*keys).distinct().alias("g")
    return index.alias("i").join(gone, same_keys("i", "g", keys), "left_anti")


def sync(index: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Bring the index to the source's current rows through its change feed (chosen columns only)."""
    feed = table_changes(index.select(*keys, *columns), source.select(*keys, *columns), keys)
    gone = feed.where(F.col("_change_type") == "delete")
    fresh = feed.where(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
    return upsert(delete(index.select(*keys, *columns), gone, keys), fresh, keys)


def scan(index: DataFrame, num_results: int = 100) -> DataFrame:
    """Some entries of the index, in no particular order."""
    return index.limit(num_results)


def bm25(df: DataFrame, key: str, text: str, terms: list[str]) -> DataFrame:
    """BM25 score of every row holding a query term.

    Words are runs of letters and digits of the whole text. Texts are read once: lengths and term
    counts are written to the shared folder, and both the corpus totals (one row) and the scores
    come from those few numbers.
    """
    wanted = sorted({t.lower() for t in terms})
    # Words parted by two blanks: neighbours share none, so plain replacement counts whole words.
    words = F.trim(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", "  "))
    padded = F.concat(F.lit(" "), F.col("_words"), F.lit(" "))
    times = lambda inner, part: (F.length(inner) - F.length(F.replace(inner, F.lit(part), F.lit("")))) / len(part)
    length = F.when(F.col("_words") == "", 0).otherwise(times(F.col("_words"), "  ") + 1)
    occurrences = [times(padded, f" {t} ").cast("int").alias(f"_tf{i}") for i, t in enumerate(wanted)]
    tokens = df.select(key, words.alias("_words")).select(key, length.cast("int").alias("_len"), *occurrences)
    base = cut_lineage(tokens, "bm25")
    totals = base.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("_len").alias("avg_len"),
        *[F.sum(F.when(F.col(f"_tf{i}") > 0, 1).otherwise(0)).alias(f"df{i}") for i in range(len(wanted))],
    ).head()
    score, hit = F.lit(0.0), F.lit(False)
    norm = F.lit(BM25_K1) * (F.lit(1 - BM25_B) + F.lit(BM25_B) * F.col("_len") / F.lit(float(totals.avg_len or 1.0)))
    for i in range(len(wanted)):
        holding = totals[f"df{i}"] or 0
        idf = math.log(1.0 + (totals.n - holding + 0.5) / (holding + 0.5))
        tf = F.col(f"_tf{i}").cast("double")
        score = score + F.lit(idf) * tf * F.lit(BM25_K1 + 1) / (tf + norm)
        hit = hit | (F.col(f"_tf{i}") > 0)
    return base.where(hit).select(key, score.alias("keyword_score"))


def _ranked(scored: DataFrame, score: str, key: str, rank: str) -> DataFrame:
    """The exact position of every row by falling score: rows are sorted in ranges, numbered within their
    range, and shifted by the sizes of the ranges before it (one small row for each range)."""
    order = [F.col(score).desc(), F.col(key)]
    placed = cut_lineage(scored.select(key, score).repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranked")
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    shifts = sizes.select("_range", (F.sum("_n").over(W.orderBy("_range")) - F.col("_n")).alias("_shift"))
    inside = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return placed.withColumn("_inside", inside).join(shifts, "_range").select(key, (F.col("_inside") + F.col("_shift")).alias(rank))


def hybrid(
    vectors: DataFrame, vector: str, query: list[float], documents: DataFrame, text: str, terms: list[str], key: str, k: int = NUM_RESULTS
) -> DataFrame:
    """Reciprocal rank fusion of all rows by cosine and by keyword score."""
    by_vector = _ranked(vectors.withColumn("score", cosine(F.col(vector), query)), "score", key, "_vr")
    by_words = _ranked(bm25(documents, key, text, terms), "keyword_score", key, "_kr")
    both = by_vector.join(by_words, key, "full_outer")
    part = lambda r: F.coalesce(1.0 / (F.lit(RRF_CONSTANT) + F.col(r)), F.lit(0.0))
    return both.select(key, (part("_vr") + part("_kr")).alias("score")).orderBy(F.col("score").desc(), F.col(key)).limit(k)
