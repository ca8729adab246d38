"""Registered queries: profiles, monitors, metric views, secured views and vector search."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import functions as F

from laminae.operators import metrics, monitor, profile, security, vectors
from laminae.operators.keyword_index import KeywordIndex
from laminae.operators.vector_index import VectorIndex, best_each
from laminae.plans.registry import ORACLES, Tables, at, query
from laminae.plans.snapshots import DATES, active_customers, active_sql
from laminae.session import cut_lineage, scratch_path

# ---- profiles ----------------------------------------------------------------------------------


def profile_sql(source: str, kinds: dict[str, str], group: str | None = None, name: str | None = None, digits: int = 4) -> str:
    """The exact part of a profile, one SELECT per column."""
    parts = []
    for column, kind in kinds.items():
        extremes = f"CAST(MIN({column}) AS VARCHAR), CAST(MAX({column}) AS VARCHAR)" if kind in ("numeric", "timestamp") else "NULL, NULL"
        moments = f"ROUND(AVG({column}), {digits}), ROUND(stddev_samp({column}), {digits})" if kind == "numeric" else "NULL, NULL"
        lead = "".join(x for x in [f"'{name}', " if name else "", f"{group}, " if group else ""])
        parts.append(
            f"SELECT {lead}'{column}', '{kind}', COUNT(*), CAST(COUNT(*) FILTER (WHERE {column} IS NULL) AS BIGINT), {extremes}, {moments} FROM {source}"
            + (f" GROUP BY {group}" if group else "")
        )
    names = [*(["table_name"] if name else []), *(["window_start"] if group else []), "column_name", "data_type", *profile.EXACT_FIELDS]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) p({', '.join(names)})"


def rounded(df, digits=4):
    return df.withColumns({c: F.round(c, digits) for c in ("mean_value", "stddev_value") if c in df.columns})


ORDER_KINDS = {"o_orderkey": "numeric", "o_custkey": "numeric", "o_orderstatus": "categorical", "o_totalprice": "numeric", "o_orderdate": "timestamp", "o_orderpriority": "categorical"}
PART_KINDS = {"p_partkey": "numeric", "p_name": "categorical", "p_brand": "categorical", "p_type": "categorical", "p_size": "numeric", "p_retailprice": "numeric"}
EVENT_KINDS = {"event_id": "id", "user_id": "id", "event_type": "categorical", "value": "numeric", "props": "categorical"}
ACTIVE_KINDS = {"o_custkey": "numeric", "order_count": "numeric", "total_spent": "numeric", "last_order": "timestamp"}


@query("profile_columns", profile_sql("orders", ORDER_KINDS))
def profile_columns(spark, sf):
    return rounded(profile.profile(Tables(spark, sf).orders, approx=False))


@query("profile_columns_approx")
def profile_columns_approx(spark, sf):
    return profile.profile(Tables(spark, sf).lineitem)


@query(
    "profile_value_counts",
    "SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, COUNT(*) AS count FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, COUNT(*) FROM orders GROUP BY 2",
)
def profile_value_counts(spark, sf):
    orders = Tables(spark, sf).orders
    return profile.value_counts(orders, profile.countable_columns(orders))


@query("profile_samples")
def profile_samples(spark, sf):
    return profile.sample_rows(Tables(spark, sf).orders)


@query(
    "profile_levels",
    f"SELECT column_name, data_type, total_count, null_count, min_value, max_value, mean_value FROM ({profile_sql('part', PART_KINDS)})",
)
def profile_levels(spark, sf):
    return profile.at_level(rounded(profile.profile(Tables(spark, sf).part, approx=False)), "SIMPLE")


@query("profile_tables", profile_sql("orders", ORDER_KINDS, name="orders") + " UNION ALL " + profile_sql("part", PART_KINDS, name="part"))
def profile_tables(spark, sf):
    t = Tables(spark, sf)
    names = profile.match_tables(["orders", "part", "customer"], ["o*", "par?"])
    return rounded(profile.profile_tables({n: getattr(t, n) for n in names}, approx=False))


@query("profile_files")
def profile_files(spark, sf):
    return profile.profile_files(spark, f"{sf}/orders.parquet")


# ---- monitors ----------------------------------------------------------------------------------


@query("monitor_snapshot", f"SELECT 1 AS refresh_id, * FROM ({profile_sql('part', PART_KINDS, name='part')})")
def monitor_snapshot(spark, sf):
    return rounded(monitor.snapshot(Tables(spark, sf).part, "part", 1, approx=False))


@query(
    "monitor_time_series",
    " UNION ALL ".join(
        f"SELECT '{g}' AS granularity, * FROM ({profile_sql('events', EVENT_KINDS, group=b)})"
        for g, b in (("1 day", "date_trunc('day', ts)::TIMESTAMP"), ("1 hour", "date_trunc('hour', ts)::TIMESTAMP"))
    ),
)
def monitor_time_series(spark, sf):
    return rounded(monitor.time_series(Tables(spark, sf).events, "ts", ["1 day", "1 hour"], approx=False))


@query(
    "monitor_inference",
    """WITH p AS (SELECT time_bucket(INTERVAL 30 DAY, l_shipdate, TIMESTAMP '1970-01-01') AS window_start, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS p, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)
SELECT window_start, COUNT(*) AS predictions, COUNT(*) FILTER (WHERE p = y) AS correct, COUNT(*) FILTER (WHERE p = 1 AND y = 1) AS true_positive, COUNT(*) FILTER (WHERE p = 1 AND y = 0) AS false_positive,
 COUNT(*) FILTER (WHERE p = 0 AND y = 1) AS false_negative, COUNT(*) FILTER (WHERE p = 0 AND y = 0) AS true_negative, ROUND(AVG(CASE WHEN p = y THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p GROUP BY 1""",
)
def monitor_inference(spark, sf):
    """Returned lines as predicted by a high discount."""
    log = Tables(spark, sf).lineitem.select(
        "l_shipdate",
        F.when(F.col("l_discount") > 0.05, 1).otherwise(0).alias("prediction"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
    )
    return monitor.inference(log, "l_shipdate", "prediction", "label", "30 days")


@query(
    "monitor_refresh_history",
    "WITH m AS ("
    + " UNION ALL ".join(f"SELECT {i + 1} AS refresh_id, * FROM ({profile_sql(f'({active_sql(d)})', ACTIVE_KINDS, name='customers', digits=8)})" for i, d in enumerate(DATES))
    + """) SELECT table_name, column_name, refresh_id, total_count, total_count - lag(total_count) OVER w AS row_change, ROUND(null_count / total_count - lag(null_count / total_count) OVER w, 6) AS null_rate_change,
 ROUND(mean_value - lag(mean_value) OVER w, 6) AS mean_change FROM m WINDOW w AS (PARTITION BY table_name, column_name ORDER BY refresh_id)""",
)
def monitor_refresh_history(spark, sf):
    orders = Tables(spark, sf).orders
    log = None
    for i, d in enumerate(DATES):
        one = monitor.snapshot(active_customers(orders, d), "customers", i + 1, approx=False)
        log = one if log is None else log.unionByName(one)
    return monitor.refresh_history(rounded(log, 8))


# ---- metric views ------------------------------------------------------------------------------


def order_metrics(spark, sf) -> metrics.MetricView:
    t = Tables(spark, sf)
    region = metrics.Join("region", t.region, on="nation.n_regionkey = region.r_regionkey")
    nation = metrics.Join("nation", t.nation, on="customer.c_nationkey = nation.n_nationkey", joins=[region])
    customer = metrics.Join("customer", t.customer, on="source.o_custkey = customer.c_custkey", joins=[nation])
    return metrics.MetricView(
        source=t.orders,
        dimensions={
            "Order Month": "date_format(o_orderdate, 'yyyy-MM')",
            "Order Year": "year(o_orderdate)",
            "Order Status": "o_orderstatus",
            "Region": "region.r_name",
            "Segment": "customer.c_mktsegment",
        },
        measures={
            "Order Count": "count(*)",
            "Total Revenue": "sum(cast(o_totalprice AS decimal(18,2)))",
            "Largest Order": "max(o_totalprice)",
            "Customers": "count(distinct o_custkey)",
        },
        filter="o_totalprice > 0",
        joins=[customer],
        combine={"Order Count": "count", "Total Revenue": "sum", "Largest Order": "max"},
    )


def plain(df):
    """Decimal results as doubles, the type the SQL twin returns."""
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c, t in df.dtypes if t.startswith("decimal")})


_METRIC_FROM = """FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE o_totalprice > 0"""
_REVENUE = "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"


@query(
    "metric_joins",
    f"""SELECT r_name AS "Region", c_mktsegment AS "Segment", COUNT(*) AS "Order Count", {_REVENUE} AS "Total Revenue" {_METRIC_FROM} GROUP BY 1, 2""",
)
def metric_joins(spark, sf):
    return plain(metrics.query(order_metrics(spark, sf), ["Order Count", "Total Revenue"], ["Region", "Segment"], order_by="ALL"))


@query(
    "metric_query",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS "Order Month", o_orderstatus AS "Order Status", COUNT(*) AS "Order Count", COUNT(DISTINCT o_custkey) AS "Customers" {_METRIC_FROM} AND year(o_orderdate) = 1999 GROUP BY 1, 2""",
)
def metric_query(spark, sf):
    return metrics.query(
        order_metrics(spark, sf), ["Order Count", "Customers"], ["Order Month", "Order Status"], where="`Order Year` = 1999", order_by="ALL"
    )


@query("metric_total", f"""SELECT COUNT(*) AS "Order Count", MAX(o_totalprice) AS "Largest Order" {_METRIC_FROM}""")
def metric_total(spark, sf):
    return metrics.query(order_metrics(spark, sf), ["Order Count", "Largest Order"])


@query(
    "metric_materialize",
    f"""SELECT r_name AS "Region", COUNT(*) AS "Order Count", {_REVENUE} AS "Total Revenue", MAX(o_totalprice) AS "Largest Order" {_METRIC_FROM} GROUP BY 1""",
)
def metric_materialize(spark, sf):
    from laminae.session import scratch_path

    view, measures = order_metrics(spark, sf), ["Order Count", "Total Revenue", "Largest Order"]
    path = scratch_path(spark, "metric")
    # Parquet column names may not hold blanks, so the stored copy is written as ORC.
    metrics.materialize(view, ["Region", "Segment", "Order Year"], measures).write.orc(path)
    return plain(metrics.query_materialized(view, spark.read.orc(path), measures, ["Region"], order_by="ALL"))


# ---- functions, row filters, column masks ------------------------------------------------------


@query("sql_udf", "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def sql_udf(spark, sf):
    security.create_function(spark, "laminae_net", "price DOUBLE, discount DOUBLE", "DOUBLE", "price * (1 - discount)")
    net = security.call("laminae_net", ["l_extendedprice", "l_discount"]).alias("net")
    return Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", net)


@query("row_filter", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def row_filter(spark, sf):
    allowed = security.member_of(["analysts"], "admins") | (F.col("c_mktsegment") == "BUILDING")
    return security.SecuredView(Tables(spark, sf).customer).set_row_filter(allowed).read()


@query(
    "column_mask",
    "SELECT c_custkey, left(c_name, 1) || '***' AS c_name, c_nationkey, CAST(NULL AS DOUBLE) AS c_acctbal, c_mktsegment FROM customer",
)
def column_mask(spark, sf):
    view = security.SecuredView(Tables(spark, sf).customer)
    view.set_mask("c_name", F.concat(F.left("c_name", F.lit(1)), F.lit("***")))
    view.set_mask("c_acctbal", F.when(security.member_of(["analysts"], "finance"), F.col("c_acctbal")))
    return view.read()


AMOUNT_SQL = "CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium' ELSE 'large' END"


@query("py_udf", f"SELECT o_orderkey, {AMOUNT_SQL} AS category, {AMOUNT_SQL} AS category_py FROM orders")
def py_udf(spark, sf):
    """The built-in expression and its Arrow-batched Python twin side by side."""

    @F.pandas_udf("string")
    def category(amount: pd.Series) -> pd.Series:
        return pd.cut(amount, [float("-inf"), 100000, 300000, float("inf")], right=False, labels=["small", "medium", "large"]).astype(object)

    price = F.col("o_totalprice")
    native = F.when(price < 100000, "small").when(price < 300000, "medium").otherwise("large")
    return Tables(spark, sf).orders.select("o_orderkey", native.alias("category"), category(price).alias("category_py"))


# ---- vectors -----------------------------------------------------------------------------------


def first_vector(spark, sf) -> list[float]:
    """The query vector: the stored vector with the smallest id (one row)."""
    return list(Tables(spark, sf).embeddings.orderBy("vec_id").head().embedding)


def vec_sql(where: str = "TRUE", k: int = 5) -> str:
    return f"""SELECT vec_id, label, ROUND(score, 8) AS score FROM (SELECT vec_id, label, list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1)) AS score
FROM embeddings WHERE {where}) ORDER BY score DESC, vec_id LIMIT {k}"""


@query("vec_topk", vec_sql())
def vec_topk(spark, sf):
    got = vectors.topk(Tables(spark, sf).embeddings, "embedding", first_vector(spark, sf), "vec_id", columns=["vec_id", "label"])
    return got.withColumn("score", F.round("score", 8))


@query("vec_filter", vec_sql("label IN (1, 2) AND vec_id > 10", 10))
def vec_filter(spark, sf):
    base = Tables(spark, sf).embeddings.where("vec_id > 10")
    got = vectors.topk(base, "embedding", first_vector(spark, sf), "vec_id", 10, ["vec_id", "label"], {"label": [1, 2]})
    return got.withColumn("score", F.round("score", 8))


@query("vec_ann")
def vec_ann(spark, sf):
    return vectors.ann(Tables(spark, sf).embeddings, "embedding", first_vector(spark, sf), "vec_id")


@query("vec_index_recall", "SELECT 10 AS k, CASE WHEN COUNT(*) < 10 THEN COUNT(*) ELSE 10 END AS found, TRUE AS enough FROM embeddings")
def vec_index_recall(spark, sf):
    """A stored index finds nine tenths of the ten nearest rows of ten rows, and as many as there are to find."""
    rows = Tables(spark, sf).embeddings.select("vec_id", "embedding", "label")
    index = VectorIndex.build(rows, scratch_path(spark, "vectors"), "vec_id", "embedding")
    asked = rows.orderBy(F.xxhash64("vec_id")).limit(10).collect()
    queries = {r.vec_id: r.embedding for r in asked}
    found = cut_lineage(index.search_each(queries, 10), "near")
    wanted = cut_lineage(best_each(rows, "vec_id", "embedding", queries, 10), "near")
    met = wanted.join(found.select("asked", "vec_id", F.lit(1).alias("hit")), ["asked", "vec_id"], "left")
    each = found.groupBy("asked").count()
    return met.agg((F.sum("hit") >= 0.9 * F.count(F.lit(1))).alias("enough")).select(
        F.lit(10).alias("k"), each.agg(F.min("count")).scalar().alias("found"), "enough"
    )


@query("vec_index_sync", vec_sql("label <> 1", 10).replace("vec_id, label, ROUND", "vec_id, CASE WHEN label = 0 THEN 100 ELSE label END AS label, ROUND"))
def vec_index_sync(spark, sf):
    """A stored index brought to a source that lost one label and renumbered another; all of its lists are searched."""
    rows = Tables(spark, sf).embeddings.select("vec_id", "embedding", "label")
    index = VectorIndex.build(rows, scratch_path(spark, "vectors"), "vec_id", "embedding")
    index.delete(rows.where("label = 1 AND vec_id % 2 = 0"))
    index.upsert(rows.where("label = 0 AND vec_id % 2 = 0").withColumn("label", F.lit(100)))
    index.sync(rows.where("label <> 1").withColumn("label", F.when(F.col("label") == 0, 100).otherwise(F.col("label"))))
    got = index.search(first_vector(spark, sf), 10, len(index.centroids), ["vec_id", "label"])
    return got.withColumn("score", F.round("score", 8))


# Fixed value: the words of the hybrid query.
HYBRID_TERMS = ["the", "that", "than"]


@query("vec_hybrid")
def vec_hybrid(spark, sf):
    t = Tables(spark, sf)
    docs = t.documents.withColumnRenamed("doc_id", "vec_id")
    return vectors.hybrid(t.embeddings, "embedding", first_vector(spark, sf), docs, "text", HYBRID_TERMS, "vec_id")


@query("vec_keyword",
    """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS words FROM documents),
c AS (SELECT doc_id, len(words) AS n, len(list_filter(words, lambda x: x = 'than')) AS t0, len(list_filter(words, lambda x: x = 'that')) AS t1, len(list_filter(words, lambda x: x = 'the')) AS t2 FROM w),
g AS (SELECT COUNT(*) AS docs, AVG(n) AS avg_n, COUNT(*) FILTER (WHERE t0 > 0) AS d0, COUNT(*) FILTER (WHERE t1 > 0) AS d1, COUNT(*) FILTER (WHERE t2 > 0) AS d2 FROM c),
s AS (SELECT doc_id, 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n / avg_n) AS norm, c.*, g.* FROM c, g WHERE t0 > 0 OR t1 > 0 OR t2 > 0)
SELECT doc_id, ROUND(ln(1 + (docs - d0 + 0.5::DOUBLE) / (d0 + 0.5::DOUBLE)) * t0 * 2.2::DOUBLE / (t0 + norm) + ln(1 + (docs - d1 + 0.5::DOUBLE) / (d1 + 0.5::DOUBLE)) * t1 * 2.2::DOUBLE / (t1 + norm)
 + ln(1 + (docs - d2 + 0.5::DOUBLE) / (d2 + 0.5::DOUBLE)) * t2 * 2.2::DOUBLE / (t2 + norm), 6) AS keyword_score FROM s""",
)
def vec_keyword(spark, sf):
    """The keyword half of hybrid search."""
    got = vectors.bm25(Tables(spark, sf).documents, "doc_id", "text", HYBRID_TERMS)
    return got.withColumn("keyword_score", F.round("keyword_score", 6))


@query("vec_keyword_index", ORACLES["vec_keyword"])
def vec_keyword_index(spark, sf):
    """The same scores from stored postings: no text is read for the query."""
    index = KeywordIndex.build(Tables(spark, sf).documents, scratch_path(spark, "postings"), "doc_id", "text")
    return index.scores(HYBRID_TERMS).withColumn("keyword_score", F.round("keyword_score", 6))


@query("vec_keyword_topk", f"SELECT * FROM ({ORACLES['vec_keyword']}) ORDER BY keyword_score DESC, doc_id LIMIT 20")
def vec_keyword_topk(spark, sf):
    """The best of them, by the blocks that can hold them."""
    index = KeywordIndex.build(Tables(spark, sf).documents, scratch_path(spark, "postings"), "doc_id", "text")
    return index.search(HYBRID_TERMS, 20).withColumn("keyword_score", F.round("keyword_score", 6))


@query("vec_upsert", "SELECT vec_id, CASE WHEN label = 0 THEN 100 ELSE label END AS label FROM embeddings")
def vec_upsert(spark, sf):
    index = Tables(spark, sf).embeddings.select("vec_id", "label")
    return vectors.upsert(index, index.where("label = 0").withColumn("label", F.lit(100)), ["vec_id"])


@query("vec_delete", "SELECT vec_id, label FROM embeddings WHERE label <> 1")
def vec_delete(spark, sf):
    index = Tables(spark, sf).embeddings.select("vec_id", "label")
    return vectors.delete(index, index.where("label = 1"), ["vec_id"])


@query("vec_scan")
def vec_scan(spark, sf):
    return vectors.scan(Tables(spark, sf).embeddings.select("vec_id", "label"))


@query("vec_sync", "SELECT vec_id, CASE WHEN label = 0 THEN 100 ELSE label END AS label FROM embeddings WHERE label <> 1")
def vec_sync(spark, sf):
    """The source lost one label and renumbered another since the index was built."""
    index = Tables(spark, sf).embeddings.select("vec_id", "label")
    source = index.where("label <> 1").withColumn("label", F.when(F.col("label") == 0, 100).otherwise(F.col("label")))
    return vectors.sync(index, source, ["vec_id"], ["label"])
