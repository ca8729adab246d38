"""From raw documents to packed training sequences: five stages, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laminae.llm import chains, packing, quality, shingles, toxicity
from laminae.session import cut_lineage, scratch_path


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows whose toxicity score is below one half."""
    model = toxicity.train(docs, _labels(spark, sf_dir))
    return docs.filter(toxicity.score(model, F.col("text")) < 0.5)


def keep_fluent(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows whose perplexity is within their language's threshold."""
    found = quality.classify(docs, _labels(spark, sf_dir))
    rejected = cut_lineage(found.filter("NOT keep").select("doc_id", "row"), "rejected")
    row = F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    rows = docs.select(_packed(docs), F.col("doc_id").cast("long").alias("id"), row.alias("hash"))
    same = (F.col("hash") == F.col("row")) & F.col("id").eqNullSafe(F.col("doc_id"))
    return rows.join(rejected, same, "left_anti").select("packed.*")


def _packed(docs: DataFrame) -> Column:
    """A row as one column, so that no column of it clashes with those that a stage adds."""
    return F.struct(*[F.col(c) for c in docs.columns]).alias("packed")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates (five-word shingles of similarity 0.8 or more, found in
    tiles of SimHash fingerprints, through any number of links): that of the smallest id, then text hash; a null id comes last. Of repeated rows of an id one
    is kept."""
    key = ["id", "none", "hash"]
    rows = docs.select(_packed(docs), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none"), shingles.text_hash(F.col("text")).alias("hash"))
    own = rows.groupBy(*key).agg(F.count("*").alias("copies"))
    rooted = own.join(shingles.groups(docs), "hash", "left").withColumn("root", F.coalesce("root", "hash"))
    least = rooted.groupBy("root").agg(F.min(F.struct("none", "id", "hash", "copies")).alias("least"))
    chosen = cut_lineage(least.select("least.*"), "chosen")
    joined = rows.join(chosen, key)
    once = joined.filter("copies = 1").select("packed")
    return once.unionAll(joined.filter("copies > 1").dropDuplicates(key).select("packed")).select("packed.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes passages that stand in an earlier place out of the texts; n_chars follows."""
    found = chains.without(docs, chains.passages(docs))
    return found.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 ids, with their ids' checksum."""
    return packing.with_crc(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_fluent),
    ("near_duplicates", one_of_each),
    ("repeats", cut_repeats),
    ("packing", pack),
]

# The classifier, the language model, the shingle comparison, alignment and the tokenizer have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
