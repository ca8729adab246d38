"""One query for each operator, over the whole of its table, and the pipeline."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laminae.llm import bpe, chains, dense_topk, fingerprints, lattice, packing, prefix_forest, quality, runs, simhash_tiles, spelling, toxicity, warc
from laminae.llm.columns import held_out
from laminae.session import cut_lineage

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
CRAWLED = "2024-01-01T00:00:00Z"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ids = bpe.encode(_table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)
    both = bpe.decode(ids, RANKS, public_tokenizers.PATTERN)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def responses(pages: DataFrame) -> DataFrame:
    """Response records of the pages."""
    url, html = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.octet_length(html).cast("string"))
    return pages.select(
        warc.record_id(F.lit("response"), F.col("page_id").cast("string"), url).alias("record_id"),
        url.alias("target_uri"),
        F.lit(CRAWLED).alias("warc_date"),
        head.alias("http_headers"),
        html.alias("payload"),
    )


def op2_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derive(responses(_table(spark, folder, "pages")))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.train(docs, labels.filter(~held_out("doc_id", 5)))
    scored = docs.select("doc_id", held_out("doc_id", 5).alias("held_out"), toxicity.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return chains.passages(_table(spark, folder, "documents")).drop("part")


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.with_crc(packing.pack(_table(spark, folder, "documents"), WORD_TOKENIZER, END_ID))
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.classify(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.select(F.explode(F.sequence(F.lit(1), "copies")).alias("copy"), "*").select("doc_id", "lang", "n_tokens", "perplexity", "drawn_perplexity", "threshold", "keep")


def op7_lattice_scores(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.score(_table(spark, folder, "documents"), PIECES)


def op8_simhash_tiles(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_tiles.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    made = fingerprints.fingerprint_edits(_table(spark, folder, "documents"))
    made = fingerprints.compare(made, "fingerprint", "edited_fingerprint", "near_edited")
    made = fingerprints.compare(made, "fingerprint", "next_fingerprint", "near_next")
    prints = cut_lineage(made.drop("next_fingerprint"), "fingerprints")
    near = fingerprints.near(prints, prints.filter("doc_id % 20 = 0"))
    asked = prints.join(near.withColumnRenamed("asked", "fingerprint"), "fingerprint", "left")
    query = F.col("doc_id") % 20 == 0
    return asked.select(
        "doc_id",
        "n_chars",
        F.col("edited").alias("edited_sha256"),
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.when(query, F.col("n_near")).alias("n_near"),
        F.when(query, F.col("near_id")).alias("near_id"),
    )


def op10_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    found = prefix_forest.search(rows.filter("vec_id % 20 = 0"), rows, 20)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one text in ten with a tail that repeats its first few words; a null id changes nothing."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(_table(spark, folder, "documents"), edit=repeated_tail)
    # exponents as exact fractions; of equal ones the first stays, as runs come by start, then period
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    top = F.aggregate("runs", F.get("runs", F.lit(0)), lambda best, r: F.when(more(r, best), r).otherwise(best))
    line = lambda r: F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("(1000 * top.length) div top.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return spelling.variants(spelling.word_counts(docs, min_letters=spelling.MIN_LETTERS, min_count=spelling.MIN_COUNT, edit=spelling.drop_letter))


def op13_dense_topk(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    found = dense_topk.search(rows.filter("vec_id % 50 = 0"), rows, 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_warc_derivatives,
        op3_toxicity,
        op4_repeated_passages,
        op5_packing,
        op6_quality,
        op7_lattice_scores,
        op8_simhash_tiles,
        op9_fingerprints,
        op10_prefix_forest,
        op11_periodic_runs,
        op12_spelling_variants,
        op13_dense_topk,
        pipeline,
    )
}



def _sql_text(html: str) -> str:
    text = html
    for pattern, to in warc.TO_TEXT:
        text = f"regexp_replace({text}, {_sql(pattern)}, {_sql(to)}, 'g')"
    for entity, to in warc.ENTITIES:
        text = f"replace({text}, {_sql(entity)}, {_sql(to)})"
    for pattern, to in warc.TIDY:
        text = f"regexp_replace({text}, {_sql(pattern)}, {_sql(to)}, 'g')"
    return text


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_uuid(*parts: str) -> str:
    h = f"md5(concat_ws(' ', {', '.join(parts)}))"
    return "'urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {i}, {n})" for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


_NL = "chr(13) || chr(10)"
_OP2 = f"""
WITH source AS (
  SELECT {_sql_uuid("'response'", "page_id::VARCHAR", "coalesce(url, '')")} AS rid, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
), digested AS (SELECT *, 'sha256:' || sha256(html) AS source_digest, strlen(html)::VARCHAR AS size FROM source),
records AS (
  SELECT rid, url, source_digest, 'metadata' AS warc_type, 'application/warc-fields' AS content_type,
    'source-http-status: 200' || {_NL} || 'source-content-type: text/html; charset=UTF-8' || {_NL}
    || 'source-payload-digest: ' || source_digest || {_NL} || 'source-payload-length: ' || size || {_NL}
    || 'title: ' || trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '[ \t\r\n]+', ' ', 'g')) || {_NL}
    || 'language: ' || regexp_extract(html, '(?i)<html[^>]* lang=["'']?([A-Za-z-]+)', 1) || {_NL}
    || 'outlinks: ' || len(regexp_extract_all(html, '(?i)<a [^>]*href='))::VARCHAR || {_NL}
    || 'source-header: Content-Type: text/html; charset=UTF-8' || {_NL} || 'source-header: Content-Length: ' || size || {_NL} AS block
  FROM digested
  UNION ALL
  SELECT rid, url, source_digest, 'conversion', 'text/plain; charset=UTF-8', {_sql_text("html")} FROM digested
)
SELECT {_sql_uuid("warc_type", "rid")} AS record_id, warc_type, rid AS refers_to, url AS target_uri, '{CRAWLED}' AS warc_date, content_type,
  strlen(block)::BIGINT AS content_length, 'sha256:' || sha256(block) AS block_digest, source_digest AS refers_to_payload_digest, block
FROM records
"""

_OP13 = f"""
WITH stored AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({dense_topk.SCALE} * x::DOUBLE)) AS weights FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.weights, r.weights)::BIGINT AS score
  FROM stored q JOIN stored r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES: dict[str, str] = {"op2_warc_derivatives": _OP2, "op13_dense_topk": _OP13}
