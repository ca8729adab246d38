"""Registered queries: the star schema and serving aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from laminae.functions.audit import with_ingest_metadata
from laminae.operators import quality, scd
from laminae.operators.conform import conform
from laminae.plans import gold
from laminae.plans.registry import EVENTS_NOW, Tables, at, money, query
from laminae.plans.snapshots import DATES, active_customers, active_sql

SILVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def silver(spark, sf) -> gold.Silver:
    """Silver as the contracts build it: audit columns, newest row per line key, trimmed text, rules."""
    t = Tables(spark, sf)
    layer = {}
    for name in SILVER_TABLES:
        loaded = with_ingest_metadata(getattr(t, name), "files", "samples", "tpch", name, "snapshot", EVENTS_NOW)
        if name == "lineitem":
            loaded = scd.latest_per_key(loaded, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
        layer[name] = conform(loaded, [{"type": "trim_strings"}], at=EVENTS_NOW)
    return layer


LINES_SQL = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
 l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1)"""


def build(spark, sf, name):
    model = next(m for m in gold.STAR if m.name == name)
    return quality.apply_rules(model.build(silver(spark, sf)), list(model.rules))


@query(
    "dim_date",
    """SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
 CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_of_year, monthname(d) AS month_name, left(monthname(d), 3) AS month_short, dayname(d) AS day_name,
 dayofweek(d) IN (0, 6) AS is_weekend, 'Q' || quarter(d) AS quarter_name, year(d) || '-Q' || quarter(d) AS year_quarter, strftime(d, '%Y-%m') AS year_month
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT date_trunc('year', MIN(o_orderdate)) AS lo, date_trunc('year', MAX(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS hi FROM orders))""",
)
def dim_date(spark, sf):
    """The date dimension over the whole years the orders span."""
    span = Tables(spark, sf).orders.agg(F.year(F.min("o_orderdate")).alias("lo"), F.year(F.max("o_orderdate")).alias("hi")).head()
    return gold.dim_date(spark, f"{span.lo}-01-01", f"{span.hi}-12-31")


@query(
    "dim_region_nation",
    "SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key, r_name AS region_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey",
)
def dim_region_nation(spark, sf):
    return build(spark, sf, "dim_region_nation")


@query(
    "dim_customer",
    """SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS account_balance, c_mktsegment AS market_segment, n_nationkey AS nation_key, n_name AS nation_name, r_name AS region_name
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def dim_customer(spark, sf):
    return build(spark, sf, "dim_customer")


@query(
    "dim_supplier",
    """SELECT s_suppkey AS supplier_key, s_name AS supplier_name, s_acctbal AS supplier_balance, n_nationkey AS nation_key, n_name AS nation_name, r_name AS region_name
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def dim_supplier(spark, sf):
    return build(spark, sf, "dim_supplier")


@query(
    "dim_part",
    "SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand, p_type AS part_type, p_size AS part_size, p_retailprice AS retail_price FROM part",
)
def dim_part(spark, sf):
    return build(spark, sf, "dim_part")


_FACT_SQL = f"""SELECT l_orderkey || '-' || l_linenumber AS order_line_key, l_orderkey AS order_key, l_linenumber AS line_number, o_custkey AS customer_key, l_partkey AS part_key, l_suppkey AS supplier_key,
 CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date, l_quantity AS quantity, l_extendedprice AS extended_price, l_discount AS discount_rate, l_tax AS tax_rate,
 l_extendedprice * (1 - l_discount) AS net_amount, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross_amount, o_totalprice AS order_total_price
FROM {LINES_SQL} l JOIN orders ON l_orderkey = o_orderkey"""


@query("fact_order_line", _FACT_SQL)
def fact_order_line(spark, sf):
    return build(spark, sf, "fact_order_line")


@query("gold_mv", f"SELECT customer_key, COUNT(*) AS lines, ROUND(SUM(CAST(quantity AS DECIMAL(18,2)))::DOUBLE, 2) AS units FROM ({_FACT_SQL}) GROUP BY customer_key")
def gold_mv(spark, sf):
    """A rebuilt serving table over the fact, with its own rules."""
    fact = build(spark, sf, "fact_order_line")
    out = fact.groupBy("customer_key").agg(F.count(F.lit(1)).alias("lines"), F.sum(money("quantity")).cast("double").alias("units"))
    return quality.apply_rules(out, [quality.Rule("has_lines", "lines > 0", "fail")])


_CUSTOMER_AT = """SELECT c_custkey AS customer_key, c_mktsegment AS market_segment, n_name AS nation_name, CAST(CAST(c_acctbal AS DECIMAL(18,2)) + CAST(total_spent AS DECIMAL(18,2)) AS DOUBLE) AS account_balance
FROM customer JOIN ({active}) ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"""


@query(
    "gold_scd2",
    f"""WITH a AS ({_CUSTOMER_AT.format(active=active_sql(DATES[0]))}), b AS ({_CUSTOMER_AT.format(active=active_sql(DATES[1]))})
SELECT a.*, TIMESTAMP '{DATES[0]}' AS "__START_AT", CASE WHEN b.customer_key IS NOT NULL AND b.account_balance = a.account_balance THEN NULL ELSE TIMESTAMP '{DATES[1]}' END AS "__END_AT" FROM a LEFT JOIN b ON a.customer_key = b.customer_key
UNION ALL SELECT b.*, TIMESTAMP '{DATES[1]}', NULL FROM b LEFT JOIN a ON a.customer_key = b.customer_key WHERE a.customer_key IS NULL OR a.account_balance <> b.account_balance""",
)
def gold_scd2(spark, sf):
    """The customer dimension with history over two snapshots of its active customers."""
    layer = silver(spark, sf)
    orders = layer["orders"]
    tracked = ("market_segment", "nation_name", "account_balance")

    def active(date):
        spent = active_customers(orders, date)
        balance = (money("account_balance") + money("total_spent")).cast("double")
        joined = gold.dim_customer(layer).join(spent, F.col("customer_key") == F.col("o_custkey"))
        return joined.select("customer_key", "market_segment", "nation_name", balance.alias("account_balance"))

    past = None
    for date in DATES[:2]:
        model = gold.Model("dim_customer", lambda _, d=date: active(d), 2, ("customer_key",), track=tracked)
        past = gold.refresh(model, layer, past, at(date))
    return past


@query(
    "quality_kpis",
    f"""SELECT (SELECT COUNT(*) FROM region) AS silver_region_rows, (SELECT COUNT(*) FROM nation) AS silver_nation_rows, (SELECT COUNT(*) FROM customer) AS silver_customer_rows,
 (SELECT COUNT(*) FROM orders) AS silver_orders_rows, (SELECT COUNT(*) FROM {LINES_SQL}) AS silver_lineitem_rows""",
)
def quality_kpis(spark, sf):
    return gold.quality_kpis(silver(spark, sf))


@query(
    "silver_batch",
    f"""SELECT l_orderkey, l_linenumber, trim(l_returnflag) AS l_returnflag, l_quantity, TRUE AS _is_current FROM {LINES_SQL} WHERE l_quantity > 0""",
)
def silver_batch(spark, sf):
    rules = [quality.Rule("keyed", "l_orderkey IS NOT NULL", "fail"), quality.Rule("positive", "l_quantity > 0", "drop")]
    rows = quality.apply_rules(silver(spark, sf)["lineitem"], rules)
    return rows.select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "_is_current")


@query(
    "daily_metrics",
    """SELECT CAST(o_orderdate AS DATE) AS day, COUNT(DISTINCT o_custkey) AS customers, COUNT(*) AS orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
 CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_order FROM orders GROUP BY 1""",
)
def daily_metrics(spark, sf):
    revenue = F.sum(money("o_totalprice")).cast("double")
    daily = Tables(spark, sf).orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.countDistinct("o_custkey").alias("customers"), F.count(F.lit(1)).alias("orders"), revenue.alias("revenue")
    )
    return daily.withColumn("avg_order", F.col("revenue") / F.col("orders"))


@query(
    "sales_summary_month",
    """SELECT p_type AS category, strftime(l_shipdate, '%Y-%m') AS month, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, COUNT(*) AS n,
 CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS average FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def sales_summary_month(spark, sf):
    """Joined first: a part sells a few lines a month, so summing by part and month would hardly shrink the lines and
    shuffle them once more. A part in a third of all lines is a skewed join, which Spark splits; where the parts are
    small they are sent to the lines and only sums are shuffled."""
    t = Tables(spark, sf)
    lines = t.lineitem.select("l_partkey", F.date_format("l_shipdate", "yyyy-MM").alias("month"), money("l_extendedprice").alias("s"))
    joined = lines.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    out = joined.groupBy(F.col("p_type").alias("category"), "month").agg(F.sum("s").cast("double").alias("total"), F.count(F.lit(1)).alias("n"))
    return out.withColumn("average", F.col("total") / F.col("n"))


_MONTHLY = """SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1, 2, 3"""


@query("preagg_monthly", f"SELECT * FROM ({_MONTHLY}) WHERE year = 1999")
def preagg_monthly(spark, sf):
    """The year is a range of the date itself, which reaches the scan."""
    year = Tables(spark, sf).orders.where((F.col("o_orderdate") >= at("1999-01-01")) & (F.col("o_orderdate") < at("2000-01-01")))
    return year.groupBy("o_custkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).agg(
        F.sum(money("o_totalprice")).cast("double").alias("total")
    )


@query(
    "two_level_agg",
    "SELECT user_id, CAST(date_trunc('month', ts) AS DATE) AS month, COUNT(*) AS events, COUNT(DISTINCT CAST(ts AS DATE)) AS active_days FROM events GROUP BY 1, 2",
)
def two_level_agg(spark, sf):
    daily = Tables(spark, sf).events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return daily.groupBy("user_id", F.trunc("day", "month").alias("month")).agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("active_days"))
