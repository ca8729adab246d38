"""Registered queries: scans, conformance, expressions, joins, aggregates, windows, sorting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from laminae.functions.audit import with_ingest_metadata
from laminae.operators import conform, ordered, profile
from laminae.operators.scd import latest_per_key
from laminae.operators.sketches import Sketches, SketchTable
from laminae.plans.registry import EVENTS_NOW, ORDERS_NOW, Tables, at, money, query
from laminae.session import cut_lineage, scratch_path
from laminae.sources import files, logs, tables

STAMP = "2024-02-01 00:00:00"


# ---- scans -------------------------------------------------------------------------------------


@query("scan_table", "SELECT * FROM orders")
def scan_table(spark, sf):
    tables.register_views(spark, {"laminae_orders": Tables(spark, sf).orders})
    return tables.scan_table(spark, "laminae_orders")


@query("scan_incremental", "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-01'")
def scan_incremental(spark, sf):
    return tables.above_watermark(Tables(spark, sf).orders, "o_orderdate", "1998-01-01")


@query("scan_files", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def scan_files(spark, sf):
    return files.scan_files(spark, f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")


@query("adhoc_sql", "SELECT o_orderstatus, COUNT(*) AS n FROM orders GROUP BY o_orderstatus")
def adhoc_sql(spark, sf):
    text = "SELECT o_orderstatus, COUNT(*) AS n FROM {orders} GROUP BY o_orderstatus"
    return tables.run_sql(spark, text, {"orders": Tables(spark, sf).orders})


# Fixed value: rows of a file that is written to be read back. A file whose format cannot be divided is one task's.
FILE_ROWS = 100_000


@query(
    "read_formats",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, fmt FROM part, (VALUES ('csv'), ('json'), ('orc'), ('parquet'), ('xml')) f(fmt)",
)
def read_formats(spark, sf):
    """The part table written and read back through each bundled file format."""
    from laminae.session import scratch_path

    part = Tables(spark, sf).part
    base = scratch_path(spark, "formats")
    extra = {"csv": {"header": "true"}, "xml": {"rowTag": "part", "rootTag": "parts"}}
    out = None
    for fmt in ("csv", "json", "orc", "parquet", "xml"):
        options = extra.get(fmt, {})
        part.write.format(fmt).options(maxRecordsPerFile=FILE_ROWS, **options).save(f"{base}/{fmt}")
        back = files.scan_files(spark, f"{base}/{fmt}", fmt, schema=part.schema, **options).withColumn("fmt", F.lit(fmt))
        out = back if out is None else out.unionByName(back)
    return out


@query("schema_hints", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment FROM customer")
def schema_hints(spark, sf):
    from laminae.session import scratch_path

    path = scratch_path(spark, "hints")
    Tables(spark, sf).customer.write.json(path)
    return files.scan_with_hints(spark, path, "json", "c_acctbal DECIMAL(12,2)")


@query("file_metadata_cols")
def file_metadata_cols(spark, sf):
    return files.with_file_metadata(Tables(spark, sf).supplier)


@query("folder_listing")
def folder_listing(spark, sf):
    return files.list_folder(spark, sf, "*.parquet")


@query(
    "parse_json_flatten",
    "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def parse_json_flatten(spark, sf):
    return logs.parse_json(Tables(spark, sf).events, "props", "k INT", ["event_id", "user_id"])


@query(
    "ingest_metadata",
    f"""SELECT *, TIMESTAMP '{STAMP}' AS _ingestion_timestamp, 'files' AS _source_system, 'samples' AS _source_database,
       'tpch' AS _source_schema, 'supplier' AS _source_table, 'snapshot' AS _load_type FROM supplier""",
)
def ingest_metadata(spark, sf):
    df = with_ingest_metadata(Tables(spark, sf).supplier, "files", "samples", "tpch", "supplier", "snapshot", STAMP)
    return df.withColumn("_ingestion_timestamp", tables.wall_clock("_ingestion_timestamp"))


# ---- silver steps ------------------------------------------------------------------------------

# Names padded and blanked by the data itself: the segment decides what a dirty export looks like.
DIRTY = """SELECT c_custkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN '  ' || c_name || ' ' ELSE c_name END AS c_name,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'N/A' WHEN 'HOUSEHOLD' THEN '' WHEN 'FURNITURE' THEN 'NULL' ELSE c_mktsegment END AS c_mktsegment
FROM customer"""


def dirty_customers(spark, sf):
    segment = F.col("c_mktsegment")
    return Tables(spark, sf).customer.select(
        "c_custkey",
        F.when(segment == "BUILDING", F.concat(F.lit("  "), "c_name", F.lit(" "))).otherwise(F.col("c_name")).alias("c_name"),
        F.when(segment == "MACHINERY", "N/A").when(segment == "HOUSEHOLD", "").when(segment == "FURNITURE", "NULL").otherwise(segment).alias("c_mktsegment"),
    )


@query("t_add_column", "SELECT *, c_acctbal * 2 AS doubled FROM customer")
def t_add_column(spark, sf):
    return conform.add_column(Tables(spark, sf).customer, "doubled", "c_acctbal * 2")


@query("t_trim_strings", f"SELECT c_custkey, trim(c_name) AS c_name, trim(c_mktsegment) AS c_mktsegment FROM ({DIRTY})")
def t_trim_strings(spark, sf):
    return conform.trim_strings(dirty_customers(spark, sf))


@query(
    "t_null_standardize",
    f"SELECT c_custkey, c_name, CASE WHEN c_mktsegment IN ('NULL','null','N/A','') THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM ({DIRTY})",
)
def t_null_standardize(spark, sf):
    return conform.null_standardize(dirty_customers(spark, sf))


@query("t_rename_column", "SELECT r_regionkey AS region_id, r_name FROM region")
def t_rename_column(spark, sf):
    return conform.rename_column(Tables(spark, sf).region, **{"from": "r_regionkey", "to": "region_id"})


@query("t_cast", "SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice FROM orders")
def t_cast(spark, sf):
    df = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return conform.cast_column(conform.cast_column(df, "o_orderpriority", "int", safe=True), "o_totalprice", "decimal(12,2)")


@query("t_drop_columns", "SELECT p_partkey, p_name, p_type, p_retailprice FROM part")
def t_drop_columns(spark, sf):
    return conform.drop_columns(Tables(spark, sf).part, ["p_brand", "p_size"])


SILVER_STEPS = [
    {"type": "trim_strings", "columns": "all"},
    {"type": "null_standardize"},
    {"type": "add_column", "name": "name_length", "expression": "length(c_name)"},
    {"type": "rename_column", "from": "c_mktsegment", "to": "segment"},
    {"type": "cast", "column": "name_length", "target_type": "bigint"},
]


@query(
    "t_pipeline",
    f"""SELECT c_custkey, trim(c_name) AS c_name, CASE WHEN trim(c_mktsegment) IN ('NULL','null','N/A','') THEN NULL ELSE trim(c_mktsegment) END AS segment,
       CAST(length(trim(c_name)) AS BIGINT) AS name_length, TIMESTAMP '{STAMP}' AS _silver_timestamp, TRUE AS _is_current FROM ({DIRTY})""",
)
def t_steps(spark, sf):
    df = conform.conform(dirty_customers(spark, sf), SILVER_STEPS, at=STAMP)
    return df.withColumn("_silver_timestamp", tables.wall_clock("_silver_timestamp"))


@query(
    "clean_users_pattern",
    r"""SELECT c_custkey AS user_id, lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com' AS email, c_name AS name, strptime('2024-01-15 08:30:00', '%Y-%m-%d %H:%M:%S') AS updated_at
FROM customer WHERE c_custkey IS NOT NULL AND regexp_matches(lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com', '^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$')""",
)
def clean_users_pattern(spark, sf):
    # Fixed value: the accepted shape of an e-mail address.
    email_shape = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
    email = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"), F.lower("c_mktsegment"), F.lit(".com"))
    raw = Tables(spark, sf).customer.select(
        F.col("c_custkey").alias("user_id"), email.alias("email"), F.col("c_name").alias("name"), F.lit("2024-01-15 08:30:00").alias("updated_at")
    )
    kept = raw.where(F.col("user_id").isNotNull() & F.col("email").isNotNull() & F.col("email").rlike(email_shape))
    return kept.withColumn("updated_at", F.to_timestamp_ntz("updated_at", F.lit("yyyy-MM-dd HH:mm:ss")))


_NET = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"


@query(
    "order_enrich_pattern",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS unit_price, {_NET} AS net,
 'class_' || CASE WHEN {_NET} < 10000 THEN 1 WHEN {_NET} < 40000 THEN 2 ELSE 3 END AS line_class FROM lineitem WHERE l_quantity > 0 AND l_shipdate >= TIMESTAMP '1995-01-01'""",
)
def order_enrich_pattern(spark, sf):
    """Lines shipped since a date, with what one piece costs, what is paid in the end, and a class by that."""
    net = F.expr(_NET)
    bounds = [10_000, 40_000]
    number = reduce(lambda n, bound: n + (net >= bound).cast("int"), bounds, F.lit(1))
    shipped = Tables(spark, sf).lineitem.where((F.col("l_quantity") > 0) & (F.col("l_shipdate") >= at("1995-01-01")))
    return shipped.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        net.alias("net"),
        F.concat(F.lit("class_"), number.cast("string")).alias("line_class"),
    )


@query(
    "trip_enrich_pattern",
    """SELECT l_orderkey, l_linenumber, date_diff('second', o_orderdate, l_shipdate) // 60 AS duration_minutes,
       CASE WHEN l_extendedprice > 0 THEN l_extendedprice / NULLIF(l_discount, 0) ELSE 0 END AS price_per_unit
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def trip_enrich_pattern(spark, sf):
    t = Tables(spark, sf)
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    ratio = F.when(F.col("l_extendedprice") > 0, F.col("l_extendedprice") / F.nullif("l_discount", F.lit(0.0))).otherwise(0.0)
    minutes = F.timestamp_diff("MINUTE", F.col("o_orderdate"), F.col("l_shipdate"))
    return joined.select("l_orderkey", "l_linenumber", minutes.alias("duration_minutes"), ratio.alias("price_per_unit"))


# ---- projections, filters, expressions ---------------------------------------------------------


@query("proj_columns", "SELECT o_orderkey AS order_key, o_totalprice * 1.1 AS gross FROM orders")
def proj_columns(spark, sf):
    return Tables(spark, sf).orders.select(F.col("o_orderkey").alias("order_key"), (F.col("o_totalprice") * 1.1).alias("gross"))


@query(
    "filter_compare",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderkey IS NOT NULL AND NOT (o_orderstatus IS NULL) AND o_totalprice BETWEEN 1000 AND 200000
  AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderpriority LIKE '%H%' AND o_orderstatus <> 'P' OR o_totalprice > 490000""",
)
def filter_compare(spark, sf):
    c = F.col
    calm = c("o_orderkey").isNotNull() & ~c("o_orderstatus").isNull() & c("o_totalprice").between(1000, 200000)
    urgent = c("o_orderpriority").isin("1-URGENT", "2-HIGH") & c("o_orderpriority").like("%H%") & (c("o_orderstatus") != "P")
    return Tables(spark, sf).orders.where((calm & urgent) | (c("o_totalprice") > 490000)).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "filter_relative_date",
    f"SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) >= CAST(TIMESTAMP '{EVENTS_NOW}' AS DATE) - 7",
)
def filter_relative_date(spark, sf):
    since = F.date_sub(at(EVENTS_NOW), 7)
    return Tables(spark, sf).events.where(F.col("ts") >= since.cast("timestamp_ntz")).select("event_id", "ts")


@query("filter_param", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 5000.0 AND c_mktsegment = 'BUILDING'")
def filter_param(spark, sf):
    text = "SELECT c_custkey, c_acctbal FROM {customer} WHERE c_acctbal >= :low AND c_mktsegment = :segment"
    return tables.run_sql(spark, text, {"customer": Tables(spark, sf).customer}, {"low": 5000.0, "segment": "BUILDING"})


@query("threshold_filter", "SELECT event_id, user_id, value, ts FROM events WHERE value > 100")
def threshold_filter(spark, sf):
    return Tables(spark, sf).events.where(F.col("value") > 100).select("event_id", "user_id", "value", "ts")


@query(
    "case_bucket",
    """SELECT CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS bucket, COUNT(*) AS n
FROM customer GROUP BY 1""",
)
def case_bucket(spark, sf):
    bucket = F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "low").otherwise("high")
    return Tables(spark, sf).customer.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "lateral_alias",
    "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem",
)
def lateral_alias(spark, sf):
    return tables.run_sql(
        spark,
        "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net, net * (1 + l_tax) AS gross FROM {lineitem}",
        {"lineitem": Tables(spark, sf).lineitem},
    )


# ---- joins -------------------------------------------------------------------------------------


@query(
    "join_inner",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(spark, sf):
    t = Tables(spark, sf)
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query(
    "join_left",
    "SELECT c_custkey, c_name, COUNT(o_orderkey) AS order_count FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name",
)
def join_left(spark, sf):
    """Orders are counted per customer before the join: one row per customer is shuffled, however
    many orders one customer has."""
    t = Tables(spark, sf)
    counts = t.orders.groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    joined = t.customer.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select("c_custkey", "c_name", F.coalesce("n", F.lit(0)).alias("order_count"))


@query(
    "join_snowflake_chain",
    """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def join_snowflake_chain(spark, sf):
    t = Tables(spark, sf)
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "n_name", "r_name")
    )


@query(
    "join_full_outer",
    """WITH a AS (SELECT o_custkey, COUNT(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
b AS (SELECT o_custkey, COUNT(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT COALESCE(a.o_custkey, b.o_custkey) AS custkey, a.n AS before_n, b.n AS after_n FROM a FULL OUTER JOIN b ON a.o_custkey IS NOT DISTINCT FROM b.o_custkey""",
)
def join_full_outer(spark, sf):
    orders = Tables(spark, sf).orders
    half = lambda cond: orders.where(cond).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    a, b = half(F.col("o_orderdate") < at("1998-01-01")).alias("a"), half(F.col("o_orderdate") >= at("1998-01-01")).alias("b")
    return a.join(b, F.col("a.o_custkey").eqNullSafe(F.col("b.o_custkey")), "full_outer").select(
        F.coalesce("a.o_custkey", "b.o_custkey").alias("custkey"), F.col("a.n").alias("before_n"), F.col("b.n").alias("after_n")
    )


@query(
    "join_anti_stale",
    f"""SELECT c_custkey, MAX(o_orderdate) AS last_order FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey
HAVING MAX(o_orderdate) IS NULL OR MAX(o_orderdate) < TIMESTAMP '{ORDERS_NOW}' - INTERVAL 180 DAY""",
)
def join_anti_stale(spark, sf):
    t = Tables(spark, sf)
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_order"))
    stale = F.col("last_order").isNull() | (F.col("last_order") < at(ORDERS_NOW) - F.expr("INTERVAL 180 DAYS"))
    return t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").where(stale).select("c_custkey", "last_order")


# ---- aggregates --------------------------------------------------------------------------------


@query(
    "agg_group",
    """SELECT o_orderstatus, COUNT(*) AS n, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, ROUND(AVG(o_totalprice), 4) AS average,
       MIN(o_totalprice) AS smallest, MAX(o_totalprice) AS largest FROM orders GROUP BY o_orderstatus""",
)
def agg_group(spark, sf):
    price = F.col("o_totalprice")
    return Tables(spark, sf).orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(money(price)).cast("double").alias("total"),
        F.round(F.avg(price), 4).alias("average"),
        F.min(price).alias("smallest"),
        F.max(price).alias("largest"),
    )


@query(
    "agg_distinct_count",
    "SELECT event_type, COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT CAST(ts AS DATE)) AS active_days FROM events GROUP BY event_type",
)
def agg_distinct_count(spark, sf):
    return Tables(spark, sf).events.groupBy("event_type").agg(
        F.countDistinct("user_id").alias("users"), F.countDistinct(F.to_date("ts")).alias("active_days")
    )


@query(
    "agg_conditional_rate",
    """SELECT user_id, COUNT(*) AS total, CAST(SUM(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS BIGINT) AS ok,
       ROUND(100.0 * SUM(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) / COUNT(*), 2) AS ok_rate
FROM events GROUP BY user_id HAVING COUNT(*) >= 5""",
)
def agg_conditional_rate(spark, sf):
    ok = F.sum(F.when(F.col("event_type") != "error", 1).otherwise(0))
    return (
        Tables(spark, sf).events.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("total"), ok.alias("ok"))
        .where(F.col("total") >= 5)
        .withColumn("ok_rate", F.round(F.lit(100.0) * F.col("ok") / F.col("total"), 2))
    )


@query(
    "agg_percentile",
    """SELECT l_returnflag, ROUND(quantile_cont(l_extendedprice, 0.5), 4) AS p50, ROUND(quantile_cont(l_extendedprice, 0.9), 4) AS p90,
       ROUND(quantile_cont(l_extendedprice, 0.99), 4) AS p99 FROM lineitem GROUP BY l_returnflag""",
)
def agg_percentile(spark, sf):
    got = ordered.exact_percentiles(Tables(spark, sf).lineitem, ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p90": 0.9, "p99": 0.99})
    return got.select("l_returnflag", *[F.round(c, 4).alias(c) for c in ("p50", "p90", "p99")])


@query("agg_approx_percentile")
def agg_approx_percentile(spark, sf):
    q = F.percentile_approx("l_extendedprice", [0.25, 0.5, 0.75], 10_000)
    return Tables(spark, sf).lineitem.groupBy("l_returnflag").agg(q.alias("q")).select(
        "l_returnflag", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")
    )


@query("agg_approx_distinct")
def agg_approx_distinct(spark, sf):
    return Tables(spark, sf).lineitem.groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey").alias("parts"))


@query(
    "sketch_refresh",
    "SELECT l_returnflag, COUNT(*) AS n, TRUE AS distinct_near, TRUE AS median_near FROM lineitem GROUP BY l_returnflag",
)
def sketch_refresh(spark, sf):
    """Distinct parts and the median price from a stored state that three yearly increments have refreshed: exact counts,
    and estimates within a twentieth (distinct) and a fiftieth of the rows (median)."""
    lines = Tables(spark, sf).lineitem.select("l_returnflag", "l_partkey", "l_extendedprice", "l_shipdate")
    table = SketchTable(spark, scratch_path(spark, "sketches"), Sketches(("l_returnflag",), ("l_partkey",), ("l_extendedprice",)))
    cuts = [at("1995-01-01"), at("1998-01-01")]
    when = F.coalesce(F.col("l_shipdate"), cuts[0])
    for n, part in enumerate([when < cuts[0], (when >= cuts[0]) & (when < cuts[1]), when >= cuts[1]], 1):
        table.refresh(lines.where(part), n)
    held = cut_lineage(table.estimates({"median": 0.5}), "estimates").withColumnRenamed("n", "stored")
    below = F.sum((F.col("l_extendedprice") <= F.col("l_extendedprice_median")).cast("int"))
    # the exact figures, from all rows
    parts = lines.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"))
    ranks = lines.join(held, "l_returnflag").groupBy("l_returnflag", "stored", "l_partkey_distinct").agg(below.alias("below"))
    return ranks.join(parts, "l_returnflag").select(
        "l_returnflag",
        F.col("stored").alias("n"),
        (F.abs(F.col("l_partkey_distinct") - F.col("parts")) <= 0.05 * F.col("parts")).alias("distinct_near"),
        (F.abs(F.col("below") / F.col("stored") - 0.5) <= 0.02).alias("median_near"),
    )


@query(
    "agg_histogram",
    """WITH b AS (SELECT MIN(value) AS lo, (MAX(value) - MIN(value)) / 10 AS w FROM events)
SELECT CAST(LEAST(FLOOR((value - lo) / w), 9) AS INTEGER) AS bin, COUNT(*) AS count FROM events, b GROUP BY 1""",
)
def agg_histogram(spark, sf):
    return profile.equi_width_histogram(Tables(spark, sf).events, "value").select("bin", "count")


@query("agg_histogram_numeric")
def agg_histogram_numeric(spark, sf):
    bins = F.histogram_numeric("value", F.lit(profile.HISTOGRAM_BINS))
    return Tables(spark, sf).events.agg(bins.alias("h")).select(F.inline("h")).toDF("bin_center", "count")


@query("agg_stddev", "SELECT event_type, ROUND(stddev_samp(value), 4) AS sd FROM events GROUP BY event_type")
def agg_stddev(spark, sf):
    return Tables(spark, sf).events.groupBy("event_type").agg(F.round(F.stddev_samp("value"), 4).alias("sd"))


SESSIONS_SQL = """WITH m AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS s
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, CAST(SUM(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_no FROM m)"""


@query(
    "agg_collect_list",
    SESSIONS_SQL
    + """ SELECT user_id, session_no, row_number() OVER (PARTITION BY user_id, session_no ORDER BY ts, event_id) AS position, event_type, ts FROM n""",
)
def agg_collect_list(spark, sf):
    """The ordered event sequence of every session, one row per step: a session of any length
    stays spread over rows instead of growing into one array cell."""
    events = Tables(spark, sf).events.select("user_id", "ts", "event_id", "event_type")
    seg = ordered.day_segment("ts")
    marked = ordered.sessions(events, ["user_id"], "ts", "event_id", 30 * 60, seg).withColumnRenamed("_session", "session_no")
    numbered = ordered.with_positions(marked, ["user_id", "session_no"], ["ts", "event_id"], seg, "position")
    return numbered.select("user_id", "session_no", "position", "event_type", "ts")


@query(
    "agg_first_seen",
    "SELECT user_id, event_type, MIN(ts) AS first_seen FROM events GROUP BY user_id, event_type",
)
def agg_first_seen(spark, sf):
    return Tables(spark, sf).events.groupBy("user_id", "event_type").agg(F.min("ts").alias("first_seen"))


@query(
    "agg_running_totals",
    "SELECT user_id, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_spent, COUNT(*) AS n, MAX(ts) AS last_at FROM events GROUP BY user_id",
)
def agg_running_totals(spark, sf):
    return Tables(spark, sf).events.groupBy("user_id").agg(
        F.sum(money("value")).cast("double").alias("total_spent"), F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_at")
    )


@query(
    "agg_global_scalars",
    "SELECT (SELECT COUNT(*) FROM region) AS regions, (SELECT COUNT(*) FROM nation) AS nations, (SELECT COUNT(*) FROM lineitem) AS lines",
)
def agg_global_scalars(spark, sf):
    t = Tables(spark, sf)
    n = lambda df: df.agg(F.count(F.lit(1))).scalar()
    return spark.range(1).select(n(t.region).alias("regions"), n(t.nation).alias("nations"), n(t.lineitem).alias("lines"))


@query(
    "agg_hourly",
    "SELECT CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INTEGER) AS event_hour, COUNT(*) AS n FROM events GROUP BY 1, 2",
)
def agg_hourly(spark, sf):
    return Tables(spark, sf).events.groupBy(F.to_date("ts").alias("event_date"), F.hour("ts").alias("event_hour")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "group_by_all",
    "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY ALL",
)
def group_by_all(spark, sf):
    return tables.run_sql(
        spark, "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM {lineitem} GROUP BY ALL", {"lineitem": Tables(spark, sf).lineitem}
    )


# ---- windows -----------------------------------------------------------------------------------


@query(
    "win_row_number",
    """SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
)
def win_row_number(spark, sf):
    return latest_per_key(Tables(spark, sf).orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query(
    "latest_per_key",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
 l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def latest_line(spark, sf):
    """Line items repeat their declared key; the newest ship date wins, further columns break ties."""
    return latest_per_key(Tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "win_moving_avg",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS s FROM orders GROUP BY 1)
SELECT day, CAST(s AS DOUBLE) AS daily, ROUND(AVG(CAST(s AS DOUBLE)) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS moving_avg_7d FROM d""",
)
def win_moving_avg(spark, sf):
    """The unpartitioned window runs over one row per calendar day."""
    daily = Tables(spark, sf).orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).cast("double").alias("daily"))
    return daily.withColumn("moving_avg_7d", F.round(F.avg("daily").over(W.orderBy("day").rowsBetween(-6, 0)), 4))


ROLLING_SQL = """SELECT event_id, user_id, ts, value, AVG(value) OVER w AS a, stddev_samp(value) OVER w AS s FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 100 PRECEDING AND CURRENT ROW)"""


def rolling_events(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "user_id", "ts", "value")
    stats = {"rolling_avg": F.avg("value"), "rolling_sd": F.stddev_samp("value")}
    return ordered.rolling(events, ["user_id"], ["ts", "event_id"], ordered.day_segment("ts"), 100, stats)


@query("win_rolling_stats", f"SELECT event_id, user_id, ROUND(a, 8) AS rolling_avg, ROUND(s, 8) AS rolling_sd FROM ({ROLLING_SQL})")
def win_rolling_stats(spark, sf):
    return rolling_events(spark, sf).select(
        "event_id", "user_id", F.round("rolling_avg", 8).alias("rolling_avg"), F.round("rolling_sd", 8).alias("rolling_sd")
    )


@query(
    "win_anomaly",
    f"""SELECT event_id, user_id, value, CASE WHEN value > a + 3 * s THEN 'HIGH_OUTLIER' WHEN value < a - 3 * s THEN 'LOW_OUTLIER' ELSE 'NORMAL' END AS anomaly_flag FROM ({ROLLING_SQL})""",
)
def win_anomaly(spark, sf):
    from laminae.streaming.anomalies import anomaly_flag

    flagged = rolling_events(spark, sf).withColumn("anomaly_flag", anomaly_flag("value", "rolling_avg", "rolling_sd"))
    return flagged.select("event_id", "user_id", "value", "anomaly_flag")


@query(
    "win_lead_lag_versions",
    """SELECT event_id, user_id, ts, lag(event_type) OVER w AS prev_type, lead(ts) OVER w AS next_ts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def win_lead_lag_versions(spark, sf):
    events = Tables(spark, sf).events.select("event_id", "user_id", "ts", "event_type")
    near = ordered.with_neighbours(events, ["user_id"], ["ts", "event_id"], ["ts", "event_type"], ordered.day_segment("ts"))
    return near.select("event_id", "user_id", "ts", F.col("_prev.event_type").alias("prev_type"), F.col("_next.ts").alias("next_ts"))


# A third of all events belongs to one user and one hour, many to the same second.
_HOT_SQL = """(SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END AS user_id, event_type, value, props,
 CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-05 12:00:00' + to_seconds(event_id * 7 % 3600) ELSE ts END AS ts FROM events) events"""


def hot_events(spark, sf):
    """Events of which a third meets in one hour of one user, and the rows a cell of them may hold: a hundredth of all."""
    e = Tables(spark, sf).events
    hot = F.col("event_id") % 3 == 0
    second = F.make_interval(secs=F.col("event_id") * 7 % 3600)
    moved = e.withColumns({
        "user_id": F.when(hot, F.lit(-1)).otherwise(F.col("user_id")).cast(e.schema["user_id"].dataType),
        "ts": F.when(hot, at("2024-01-05 12:00:00") + second).otherwise(F.col("ts")),
    })
    return moved, max(1, e.count() // 100)


@query("win_rolling_hot_day", f"SELECT event_id, user_id, ROUND(a, 8) AS rolling_avg FROM ({ROLLING_SQL.replace('FROM events', f'FROM {_HOT_SQL}')})")
def win_rolling_hot_day(spark, sf):
    events, limit = hot_events(spark, sf)
    events = events.select("event_id", "user_id", "ts", "value")
    rolled = ordered.rolling(events, ["user_id"], ["ts", "event_id"], ordered.day_segment("ts"), 100, {"a": F.avg("value")}, limit=limit)
    return rolled.select("event_id", "user_id", F.round("a", 8).alias("rolling_avg"))


@query(
    "agg_collect_list_hot_day",
    SESSIONS_SQL.replace("FROM events", f"FROM {_HOT_SQL}")
    + " SELECT user_id, session_no, row_number() OVER (PARTITION BY user_id, session_no ORDER BY ts, event_id) AS position, event_type, ts FROM n",
)
def agg_collect_list_hot_day(spark, sf):
    """Session sequences as in agg_collect_list, with cells that the data divides."""
    events, limit = hot_events(spark, sf)
    events, seg = events.select("user_id", "ts", "event_id", "event_type"), ordered.day_segment("ts")
    marked = ordered.sessions(events, ["user_id"], "ts", "event_id", 30 * 60, seg, limit).withColumnRenamed("_session", "session_no")
    numbered = ordered.with_positions(marked, ["user_id", "session_no"], ["ts", "event_id"], seg, "position", limit)
    return numbered.select("user_id", "session_no", "position", "event_type", "ts")


# ---- sorting, sets, subqueries -----------------------------------------------------------------


@query("sort_multi", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC")
def sort_multi(spark, sf):
    return Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(F.col("o_orderpriority"), F.col("o_totalprice").desc())


@query("topk", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def topk(spark, sf):
    return Tables(spark, sf).orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query("limit_sample")
def limit_sample(spark, sf):
    return profile.sample_rows(Tables(spark, sf).customer)


@query("distinct", "SELECT DISTINCT user_id, event_type FROM events")
def distinct(spark, sf):
    return Tables(spark, sf).events.select("user_id", "event_type").distinct()


@query(
    "union_all",
    "SELECT c_custkey AS party, c_acctbal AS balance, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier",
)
def union_all(spark, sf):
    t = Tables(spark, sf)
    side = lambda df, key, bal, kind: df.select(F.col(key).alias("party"), F.col(bal).alias("balance"), F.lit(kind).alias("kind"))
    return side(t.customer, "c_custkey", "c_acctbal", "customer").unionByName(side(t.supplier, "s_suppkey", "s_acctbal", "supplier"))


@query(
    "cte",
    "WITH base AS (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey) SELECT n, COUNT(*) AS customers FROM base GROUP BY n",
)
def cte(spark, sf):
    text = "WITH base AS (SELECT o_custkey, COUNT(*) AS n FROM {orders} GROUP BY o_custkey) SELECT n, COUNT(*) AS customers FROM base GROUP BY n"
    return tables.run_sql(spark, text, {"orders": Tables(spark, sf).orders})


@query(
    "subq_scalar_correlated",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate <> (SELECT MIN(o2.o_orderdate) FROM orders o2 WHERE o2.o_custkey = orders.o_custkey)""",
)
def subq_scalar_correlated(spark, sf):
    text = """SELECT o_orderkey, o_custkey, o_orderdate FROM {orders} o
              WHERE o_orderdate <> (SELECT MIN(p.o_orderdate) FROM {orders} p WHERE p.o_custkey = o.o_custkey)"""
    return tables.run_sql(spark, text, {"orders": Tables(spark, sf).orders})


# ---- scalar functions --------------------------------------------------------------------------


@query(
    "fn_date",
    f"""SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(month(o_orderdate) AS INTEGER) AS m,
 CAST(day(o_orderdate) AS INTEGER) AS d, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow, CAST(weekofyear(o_orderdate) AS INTEGER) AS wk, strftime(o_orderdate, '%Y-%m') AS ym,
 date_trunc('month', o_orderdate)::TIMESTAMP AS month_start, CAST(date_diff('day', o_orderdate, TIMESTAMP '{ORDERS_NOW}') AS INTEGER) AS age_days,
 o_orderdate + INTERVAL 1 HOUR AS later, CAST(epoch(o_orderdate) AS BIGINT) AS unix_s, CAST(o_orderdate AS DATE) AS just_date, CAST(extract(hour FROM o_orderdate) AS INTEGER) AS h
FROM orders""",
)
def fn_date(spark, sf):
    d = F.col("o_orderdate")
    return Tables(spark, sf).orders.select(
        "o_orderkey",
        F.year(d).alias("y"),
        F.quarter(d).alias("q"),
        F.month(d).alias("m"),
        F.day(d).alias("d"),
        F.dayofweek(d).alias("dow"),
        F.weekofyear(d).alias("wk"),
        F.date_format(d, "yyyy-MM").alias("ym"),
        F.date_trunc("month", d).cast("timestamp_ntz").alias("month_start"),
        F.datediff(at(ORDERS_NOW), d).alias("age_days"),
        (d + F.expr("INTERVAL 1 HOUR")).alias("later"),
        F.unix_timestamp(d.cast("timestamp")).alias("unix_s"),
        F.to_date(d).alias("just_date"),
        F.extract(F.lit("HOUR"), d).alias("h"),
    )


@query(
    "fn_string",
    """SELECT doc_id, lower(lang) || '-' || source AS tag, left(text, 100) AS preview, length(trim(text)) AS trimmed_length,
 regexp_matches(text, '[0-9]+') AS has_digits, text LIKE '%the%' AS has_the, CAST(n_chars AS VARCHAR) AS n_text FROM documents""",
)
def fn_string(spark, sf):
    text = F.col("text")
    return Tables(spark, sf).documents.select(
        "doc_id",
        F.concat(F.lower("lang"), F.lit("-"), "source").alias("tag"),
        F.left(text, F.lit(100)).alias("preview"),
        F.length(F.trim(text)).cast("long").alias("trimmed_length"),
        text.rlike("[0-9]+").alias("has_digits"),
        text.like("%the%").alias("has_the"),
        F.col("n_chars").cast("string").alias("n_text"),
    )


@query(
    "fn_math",
    "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross, l_extendedprice / l_quantity AS unit, ROUND(l_tax * 100, 0) AS tax_pct, l_quantity + l_linenumber - 1 AS mixed FROM lineitem",
)
def fn_math(spark, sf):
    c = F.col
    return Tables(spark, sf).lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (c("l_extendedprice") * (1 - c("l_discount")) * (1 + c("l_tax"))).alias("gross"),
        (c("l_extendedprice") / c("l_quantity")).alias("unit"),
        F.round(c("l_tax") * 100, 0).alias("tax_pct"),
        (c("l_quantity") + c("l_linenumber") - 1).alias("mixed"),
    )


@query(
    "fn_conditional",
    "SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'BUILDING'), 'none') AS segment, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS positive FROM customer",
)
def fn_conditional(spark, sf):
    return Tables(spark, sf).customer.select(
        "c_custkey",
        F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("segment"),
        F.when(F.col("c_acctbal") > 0, 1).otherwise(0).alias("positive"),
    )


@query(
    "fn_array",
    """SELECT vec_id, CAST(u.pos AS INTEGER) AS pos, CAST(u.x AS DOUBLE) AS x FROM embeddings, (SELECT UNNEST(generate_series(0, len(embedding) - 1)) AS pos, UNNEST(embedding) AS x) u""",
)
def fn_array(spark, sf):
    return Tables(spark, sf).embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "x")).withColumn("x", F.col("x").cast("double"))


@query(
    "fn_struct_map",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, time_bucket(INTERVAL 1 HOUR, ts) AS hour_start, event_type AS what FROM events""",
)
def fn_struct_map(spark, sf):
    events = Tables(spark, sf).events
    shaped = events.select(
        "event_id",
        F.from_json("props", "map<string,int>").alias("m"),
        F.window("ts", "1 hour").alias("w"),
        F.struct(F.col("event_type").alias("what")).alias("s"),
    )
    return shaped.select("event_id", F.col("m")["k"].alias("k"), F.col("w.start").alias("hour_start"), F.col("s.what").alias("what"))


@query(
    "fn_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, '{"event_id":' || event_id || ',"type":"' || event_type || '"}' AS as_json FROM events""",
)
def fn_json(spark, sf):
    return Tables(spark, sf).events.select(
        "event_id",
        F.from_json("props", "k INT")["k"].alias("k"),
        F.to_json(F.struct("event_id", F.col("event_type").alias("type"))).alias("as_json"),
    )
