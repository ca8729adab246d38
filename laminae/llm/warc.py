"""WARC derivative builder: from response records to linked metadata and conversion records.

Each response gives two records. The metadata record (application/warc-fields) keeps what is known of
the source: its HTTP status and headers, its digest and length, and the title, language and number of
links found in it. The conversion record is the plain text. Both name the response in
WARC-Refers-To, keep its target and date, and carry a digest of their own block. Record ids are derived
from the response's id, so building twice gives the same records.

Everything is built-in functions on the responses' columns: one scan, no shuffle.

Defined cases: null columns are empty; a response without a header or a body gives records with
empty fields or an empty block; repeated responses give repeated records; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Markup to text. In order; each pattern has the same meaning in Java's and in RE2's syntax.
TO_TEXT = (
    (r"(?s)<!--.*?-->", " "),
    (r"(?is)<script[^>]*>.*?</script>", " "),
    (r"(?is)<style[^>]*>.*?</style>", " "),
    (r"(?is)<title[^>]*>.*?</title>", " "),
    (r"(?i)<(br|/p|/div|/li|/ul|/ol|/tr|/table|/h[1-6]|/nav|/article|/section|/header|/footer|/title|hr)[^>]*>", "\n"),
    (r"<[^>]*>", ""),
)
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
TIDY = ((r"[ \t\r\x0C]+", " "), (r" ?\n[ \n]*", "\n"), (r"^[ \n]+|[ \n]+$", ""))


def plain_text(html: Column) -> Column:
    text = html
    for pattern, to in TO_TEXT:
        text = F.regexp_replace(text, pattern, to)
    for entity, to in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(to))
    for pattern, to in TIDY:
        text = F.regexp_replace(text, pattern, to)
    return text


def record_id(*parts: Column) -> Column:
    """A uuid made from the parts."""
    h = F.md5(F.concat_ws(" ", *parts).cast("binary"))
    at = [F.substring(h, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *at))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def derive(responses: DataFrame) -> DataFrame:
    """Two records for each response, in the columns of `RECORD`.

    responses: record_id, target_uri, warc_date (strings), http_headers (status line and header lines, CRLF
    between them), payload (markup)."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    source = responses.select(*[named(c).alias(c) for c in ("record_id", "target_uri", "warc_date", "http_headers", "payload")])
    payload = F.col("payload")
    fields = [
        ("source-http-status", F.regexp_extract("http_headers", r"^HTTP/[0-9.]+ ([0-9]{3})", 1)),
        ("source-content-type", F.regexp_extract("http_headers", r"(?im)^content-type: *([^\r\n]*)", 1)),
        ("source-payload-digest", digest(payload)),
        ("source-payload-length", F.octet_length(payload).cast("string")),
        ("title", F.trim(F.regexp_replace(F.regexp_extract(payload, r"(?is)<title[^>]*>(.*?)</title>", 1), r"[ \t\r\n]+", " "))),
        ("language", F.regexp_extract(payload, r"(?i)<html[^>]* lang=[\"']?([A-Za-z-]+)", 1)),
        ("outlinks", F.regexp_count(payload, F.lit(r"(?i)<a [^>]*href=")).cast("string")),
    ]
    lines = [F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")) for k, v in fields]
    kept = F.regexp_replace(F.regexp_replace("http_headers", r"^HTTP/[^\r\n]*\r?\n?", ""), r"(?m)^([^\r\n]+)\r?$", "source-header: $1")
    header_lines = F.when(kept == "", F.lit("")).otherwise(F.concat(F.regexp_replace(kept, r"\r?\n", "\r\n"), F.lit("\r\n")))
    record = lambda kind, media, block: F.struct(
        F.lit(kind).alias("warc_type"), F.lit(media).alias("content_type"), block.alias("block"), record_id(F.lit(kind), F.col("record_id")).alias("id")
    )
    both = F.array(
        record("metadata", "application/warc-fields", F.concat(*lines, header_lines)),
        record("conversion", "text/plain; charset=UTF-8", plain_text(payload)),
    )
    made = source.select("record_id", "target_uri", "warc_date", digest(payload).alias("source"), F.explode(both).alias("r"))
    return made.select(
        F.col("r.id").alias("record_id"),
        F.col("r.warc_type").alias("warc_type"),
        F.col("record_id").alias("refers_to"),
        "target_uri",
        "warc_date",
        F.col("r.content_type").alias("content_type"),
        F.octet_length("r.block").cast("long").alias("content_length"),
        digest(F.col("r.block")).alias("block_digest"),
        F.col("source").alias("refers_to_payload_digest"),
        F.col("r.block").alias("block"),
    )


def serialised(records: DataFrame) -> DataFrame:
    """Each record as the text of a WARC file without the blank lines that end it."""
    head = [
        ("WARC-Type", "warc_type"),
        ("WARC-Record-ID", "record_id"),
        ("WARC-Refers-To", "refers_to"),
        ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "warc_date"),
        ("WARC-Block-Digest", "block_digest"),
        ("Content-Type", "content_type"),
        ("Content-Length", "content_length"),
    ]
    value = lambda c: F.concat(F.lit("<"), F.col(c), F.lit(">")) if c in ("record_id", "refers_to") else F.col(c).cast("string")
    lines = [F.concat(F.lit(f"{k}: "), value(c), F.lit("\r\n")) for k, c in head]
    return records.select(F.concat(F.lit("WARC/1.1\r\n"), *lines, F.lit("\r\n"), F.col("block")).alias("record"))


def write(records: DataFrame, path: str) -> None:
    """WARC files, compressed, one for each task."""
    serialised(records).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)
