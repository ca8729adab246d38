"""Registered queries: keyed state, change feeds, quality, control, reconciliation, history."""

from __future__ import annotations

from pyspark.sql import functions as F

from laminae.functions.audit import with_ingest_metadata
from laminae.operators import changes, control, drift, health, history, quality, reconcile, scd
from laminae.plans.q_core import _HOT_SQL, hot_events
from laminae.plans.registry import EVENTS_NOW, ORDERS_NOW, Tables, at, money, query
from laminae.plans.snapshots import DATES, active_customers, active_sql, history_sql
from laminae.sources import tables

VALUES = ["order_count", "total_spent", "last_order"]
KEY = ["o_custkey"]


def snap(spark, sf, i):
    return active_customers(Tables(spark, sf).orders, DATES[i])


# ---- snapshots ---------------------------------------------------------------------------------

_SNAP_CHANGES = f"""WITH a AS ({active_sql(DATES[0])}), b AS ({active_sql(DATES[1])})
SELECT COALESCE(b.o_custkey, a.o_custkey) AS o_custkey,
 CASE WHEN b.o_custkey IS NULL THEN a.order_count ELSE b.order_count END AS order_count,
 CASE WHEN b.o_custkey IS NULL THEN a.total_spent ELSE b.total_spent END AS total_spent,
 CASE WHEN b.o_custkey IS NULL THEN a.last_order ELSE b.last_order END AS last_order,
 CASE WHEN a.o_custkey IS NULL THEN 'insert' WHEN b.o_custkey IS NULL THEN 'delete'
      WHEN a.order_count = b.order_count AND a.total_spent = b.total_spent AND a.last_order = b.last_order THEN 'unchanged' ELSE 'update' END AS _change
FROM a FULL OUTER JOIN b ON a.o_custkey = b.o_custkey"""


@query("snapshot_scd1", _SNAP_CHANGES)
def snapshot_scd1(spark, sf):
    return scd.snapshot_changes(snap(spark, sf, 0), snap(spark, sf, 1), KEY)


@query("snapshot_scd1_state", active_sql(DATES[1]))
def snapshot_scd1_state(spark, sf):
    return scd.apply_snapshot_scd1(snap(spark, sf, 0), snap(spark, sf, 1), KEY)


def customer_history(spark, sf, track=None):
    past = scd.first_history(snap(spark, sf, 0), at(DATES[0]))
    for i in (1, 2):
        past = scd.apply_snapshot_scd2(past, snap(spark, sf, i), KEY, at(DATES[i]), track=track)
    return past


HISTORY_SQL = history_sql(DATES, VALUES, VALUES)


@query("snapshot_scd2", HISTORY_SQL)
def snapshot_scd2(spark, sf):
    return customer_history(spark, sf)


@query("snapshot_scd2_track", history_sql(DATES, ["order_count"], VALUES))
def snapshot_scd2_track(spark, sf):
    return customer_history(spark, sf, ["order_count"])


@query(
    "silver_scd2",
    history_sql(DATES[:2], VALUES, VALUES),
)
def silver_scd2(spark, sf):
    """Conformed snapshots with history on the merge keys; the silver stamp opens no version."""
    from laminae.operators.conform import conform

    shaped = [
        conform(snap(spark, sf, i), [{"type": "trim_strings"}], at=f"2024-01-0{i + 1} 00:00:00").drop("_is_current") for i in (0, 1)
    ]
    past = scd.first_history(shaped[0], at(DATES[0]))
    return scd.apply_snapshot_scd2(past, shaped[1], KEY, at(DATES[1]), track_except=["_silver_timestamp"]).drop("_silver_timestamp")


# ---- increments --------------------------------------------------------------------------------

CUT = "1999-06-01"


@query(
    "incremental_append_raw",
    f"SELECT o_orderkey, o_orderdate, 'incremental' AS _load_type, 'orders' AS _source_table FROM orders WHERE o_orderdate > TIMESTAMP '{CUT}'",
)
def incremental_append_raw(spark, sf):
    fresh = tables.above_watermark(Tables(spark, sf).orders, "o_orderdate", CUT)
    stamped = with_ingest_metadata(fresh, "files", "samples", "tpch", "orders", "incremental", EVENTS_NOW)
    return stamped.select("o_orderkey", "o_orderdate", "_load_type", "_source_table")


_LATEST_ORDER = """SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1"""


@query("incremental_merge_state", _LATEST_ORDER)
def incremental_merge_state(spark, sf):
    orders = Tables(spark, sf).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")
    stored = scd.latest_per_key(orders.where(F.col("o_orderdate") <= at(CUT)), KEY, ["o_orderdate", "o_orderkey"])
    fresh = tables.above_watermark(orders, "o_orderdate", CUT)
    return scd.latest_per_key(stored.unionByName(fresh), KEY, ["o_orderdate", "o_orderkey"])


@query(
    "incremental_load",
    f"SELECT MAX(o_orderdate) AS watermark_value, COUNT(*) AS row_count FROM orders WHERE o_orderdate > TIMESTAMP '{CUT}'",
)
def incremental_load(spark, sf):
    return control.increment(Tables(spark, sf).orders, "o_orderdate", CUT)[1]


# ---- change streams ----------------------------------------------------------------------------


def change_log(spark, sf):
    """Events as a change stream of users: an error event deletes, any other event upserts."""
    e = Tables(spark, sf).events
    op = F.when(F.col("event_type") == "error", "d").otherwise("u")
    return e.select("user_id", "ts", "event_id", "event_type", "value", "props", op.alias("op"))


SEQ = ["ts", "event_id"]
_LOG_SQL = "(SELECT user_id, ts, event_id, event_type, value, props, event_type = 'error' AS del FROM events)"


def cdc_history_sql(tracked: list[str], values: list[str]) -> str:
    row = "ROW(" + ", ".join(tracked) + ")"
    return f"""WITH l AS (SELECT *, CASE WHEN NOT del THEN {row} END AS t FROM {_LOG_SQL}),
e AS (SELECT *, NOT del AND (lag(ts) OVER w IS NULL OR lag(del) OVER w OR lag(t) OVER w IS DISTINCT FROM t) AS opens,
      NOT del AND (lead(ts) OVER w IS NULL OR lead(del) OVER w OR lead(t) OVER w IS DISTINCT FROM t) AS closes, lead(ts) OVER w AS next_ts
      FROM l WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
p AS (SELECT *, CASE WHEN opens THEN ts ELSE lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) END AS start_ts FROM e WHERE opens OR closes)
SELECT user_id, {', '.join(values)}, start_ts AS "__START_AT", next_ts AS "__END_AT" FROM p WHERE closes"""


def newest_sql(*order: str) -> str:
    down = ", ".join(f"{c} DESC" for c in order)
    return f"""SELECT user_id, ts, event_id, event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {down}) AS rn FROM {_LOG_SQL}) WHERE rn = 1 AND NOT del"""


@query("cdc_scd1", newest_sql("ts", "event_id"))
def cdc_scd1(spark, sf):
    return scd.cdc_scd1(change_log(spark, sf), ["user_id"], SEQ, scd.is_delete("op"), except_columns=["op"])


@query("cdc_scd2", cdc_history_sql(["event_type", "value", "props"], ["ts", "event_id", "event_type", "value", "props"]))
def cdc_scd2(spark, sf):
    return scd.cdc_scd2(change_log(spark, sf), ["user_id"], SEQ, scd.is_delete("op"), except_columns=["op"])


@query("cdc_track_columns", cdc_history_sql(["event_type"], ["ts", "event_id", "event_type", "value", "props"]))
def cdc_track_columns(spark, sf):
    return scd.cdc_scd2(change_log(spark, sf), ["user_id"], SEQ, scd.is_delete("op"), except_columns=["op"], track=["event_type"])


@query("cdc_except_columns", cdc_history_sql(["event_type", "value"], ["ts", "event_id", "event_type", "value"]))
def cdc_except_columns(spark, sf):
    return scd.cdc_scd2(change_log(spark, sf), ["user_id"], SEQ, scd.is_delete("op"), except_columns=["op", "props"])


_HISTORY_COLUMNS = ["ts", "event_id", "event_type", "value", "props"]


@query("cdc_scd2_hot_day", cdc_history_sql(["event_type"], _HISTORY_COLUMNS).replace("FROM events", f"FROM {_HOT_SQL}"))
def cdc_scd2_hot_day(spark, sf):
    """History of a log in which one key has a third of all events within an hour."""
    events, limit = hot_events(spark, sf)
    log = events.select("user_id", *_HISTORY_COLUMNS, (F.col("event_type") == "error").alias("gone"))
    return scd.cdc_scd2(log, ["user_id"], SEQ, F.col("gone"), except_columns=["gone"], track=["event_type"], limit=limit)


_CHANGES_SQL = f"""WITH a AS ({active_sql(DATES[0])}), b AS ({active_sql(DATES[1])}),
j AS (SELECT a AS x, b AS y, a.o_custkey IS NOT NULL AS had, b.o_custkey IS NOT NULL AS has, a.order_count = b.order_count AND a.total_spent = b.total_spent AND a.last_order = b.last_order AS same
      FROM a FULL OUTER JOIN b ON a.o_custkey = b.o_custkey)
SELECT x.o_custkey AS o_custkey, x.order_count AS order_count, x.total_spent AS total_spent, x.last_order AS last_order, CASE WHEN has THEN 'update_preimage' ELSE 'delete' END AS _change_type FROM j WHERE had AND (NOT has OR NOT same)
UNION ALL SELECT y.o_custkey, y.order_count, y.total_spent, y.last_order, CASE WHEN had THEN 'update_postimage' ELSE 'insert' END FROM j WHERE has AND (NOT had OR NOT same)"""


@query("change_feed_read", _CHANGES_SQL)
def change_feed_read(spark, sf):
    return changes.table_changes(snap(spark, sf, 0), snap(spark, sf, 1), KEY)


_ACTIVITY_AGG = f"""SELECT order_count, COUNT(*) AS customers, CAST(SUM(CAST(total_spent AS DECIMAL(18,2))) AS DOUBLE) AS spent FROM ({active_sql(DATES[1])}) GROUP BY order_count"""


@query("incremental_mv", _ACTIVITY_AGG)
def incremental_mv(spark, sf):
    """The aggregate over the first snapshot, moved to the second by its change feed."""
    old, new = snap(spark, sf, 0), snap(spark, sf, 1)
    stored = old.groupBy("order_count").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(money("total_spent")).cast("decimal(38,2)").alias("spent")
    )
    moved = changes.refresh_sums(
        stored, changes.table_changes(old, new, KEY), ["order_count"], {"spent": money("total_spent")}, "customers"
    )
    return moved.withColumn("spent", F.col("spent").cast("double"))


@query(
    "incremental_mv_groups",
    f"SELECT order_count, MAX(last_order) AS newest, MIN(total_spent) AS least FROM ({active_sql(DATES[1])}) GROUP BY order_count",
)
def incremental_mv_groups(spark, sf):
    old, new = snap(spark, sf, 0), snap(spark, sf, 1)
    aggs = [F.max("last_order").alias("newest"), F.min("total_spent").alias("least")]
    return changes.refresh_groups(
        old.groupBy("order_count").agg(*aggs), changes.table_changes(old, new, KEY), new, ["order_count"], aggs
    )


# ---- quality -----------------------------------------------------------------------------------

RULES = [
    quality.Rule("quantity_over_five", "l_quantity > 5", "warn"),
    quality.Rule("taxed", "nullif(l_tax, 0.0) > 0.01", "warn"),
    quality.Rule("modest_discount", "l_discount <= 0.08", "drop"),
    quality.Rule("keyed", "l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL", "fail"),
]
# Outcome of each rule in SQL; NULL counts as a violation except for quarantine.
_CONDITIONS = {
    "quantity_over_five": ("warn", "l_quantity > 5"),
    "taxed": ("warn", "NULLIF(l_tax, 0.0) > 0.01"),
    "modest_discount": ("drop", "l_discount <= 0.08"),
    "keyed": ("fail", "l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL"),
}


def _metrics_sql(names):
    return " UNION ALL ".join(
        f"""SELECT 'lineitem' AS table_name, '{n}' AS rule_name, '{_CONDITIONS[n][0]}' AS action,
 CAST(SUM(CASE WHEN {_CONDITIONS[n][1]} THEN 1 ELSE 0 END) AS BIGINT) AS passed, CAST(SUM(CASE WHEN {_CONDITIONS[n][1]} THEN 0 ELSE 1 END) AS BIGINT) AS failed,
 ROUND(SUM(CASE WHEN {_CONDITIONS[n][1]} THEN 0 ELSE 1 END) / COUNT(*), 6) AS failed_rate FROM lineitem"""
        for n in names
    )


@query("expect_warn", _metrics_sql(["quantity_over_five", "taxed"]))
def expect_warn(spark, sf):
    return quality.quality_metrics(Tables(spark, sf).lineitem, quality.of_action(RULES, "warn"), "lineitem")


@query("quality_metrics", _metrics_sql(list(_CONDITIONS)))
def quality_metrics(spark, sf):
    return quality.quality_metrics(Tables(spark, sf).lineitem, RULES, "lineitem")


@query("expect_drop", "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE COALESCE(l_discount <= 0.08, FALSE)")
def expect_drop(spark, sf):
    return quality.expect_drop(Tables(spark, sf).lineitem, quality.of_action(RULES, "drop")).select("l_orderkey", "l_linenumber", "l_discount")


@query("expect_fail", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_discount <= 0.08")
def expect_fail(spark, sf):
    """Passes on the given data; a violating row aborts the job (tested separately)."""
    return quality.apply_rules(Tables(spark, sf).lineitem, RULES).select("l_orderkey", "l_linenumber")


@query(
    "quarantine_batch",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_tax, 'quantity_over_five,taxed' AS _quarantine_expectations,
 CASE WHEN NOT (l_quantity > 5) THEN 'quantity_over_five' ELSE '' END || '|' || CASE WHEN NOT (NULLIF(l_tax, 0.0) > 0.01) THEN 'taxed' ELSE '' END AS violated
FROM lineitem WHERE NOT (l_quantity > 5) OR NOT (NULLIF(l_tax, 0.0) > 0.01)""",
)
def quarantine_batch(spark, sf):
    held = quality.quarantine(Tables(spark, sf).lineitem, RULES, at=EVENTS_NOW)
    broke = lambda rule: F.when(F.array_contains("_violated_expectations", rule), rule).otherwise("")
    return held.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_tax", "_quarantine_expectations",
        F.concat(broke("quantity_over_five"), F.lit("|"), broke("taxed")).alias("violated"),
    )


@query(
    "flag_and_split",
    """SELECT 'invalid' AS part, l_returnflag, COUNT(*) AS n FROM lineitem WHERE l_quantity < 3 OR l_discount > 0.09 GROUP BY l_returnflag
UNION ALL SELECT 'clean', l_returnflag, COUNT(*) FROM lineitem WHERE NOT (l_quantity < 3 OR l_discount > 0.09) GROUP BY l_returnflag""",
)
def flag_and_split(spark, sf):
    clean, bad = quality.split_flagged(quality.flag_invalid(Tables(spark, sf).lineitem, "l_quantity < 3 OR l_discount > 0.09"))
    both = clean.select(F.lit("clean").alias("part"), "l_returnflag").unionByName(bad.select(F.lit("invalid").alias("part"), "l_returnflag"))
    return both.groupBy("part", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "drift_evolve",
    """SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice, NULL::VARCHAR AS p_brand FROM part
UNION ALL SELECT p_partkey, p_name, CAST(p_size AS BIGINT), NULL, p_brand FROM part""",
)
def drift_evolve(spark, sf):
    part = Tables(spark, sf).part
    old = part.select("p_partkey", "p_name", "p_size", "p_retailprice")
    new = part.select("p_partkey", "p_name", F.col("p_size").cast("bigint").alias("p_size"), "p_brand")
    return drift.evolve_union(old, new)


@query(
    "drift_evolve_nested",
    """SELECT o_orderkey, o_orderstatus AS status, o_totalprice AS price, NULL::VARCHAR AS priority, 1::BIGINT AS steps, NULL::VARCHAR AS last_step, o_custkey::BIGINT AS rank, NULL::BIGINT AS year FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus, NULL, o_orderpriority, 2, o_orderpriority, o_custkey, year(o_orderdate) FROM orders""",
)
def drift_evolve_nested(spark, sf):
    """Two deliveries of nested orders: the second has other fields in its struct, in its array's structs and in its
    map's, and a wider number."""
    o = Tables(spark, sf).orders
    first = o.select(
        "o_orderkey",
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")).alias("head"),
        F.array(F.struct(F.col("o_orderstatus").alias("code"))).alias("steps"),
        F.create_map(F.lit("ship"), F.struct(F.col("o_custkey").cast("int").alias("rank"))).alias("notes"),
    )
    second = o.select(
        "o_orderkey",
        F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")).alias("head"),
        F.array(*[F.struct(F.col("o_orderstatus").alias("code"), F.col("o_orderpriority").alias("text"))] * 2).alias("steps"),
        F.create_map(F.lit("ship"), F.struct(F.year("o_orderdate").cast("bigint").alias("year"), F.col("o_custkey").cast("bigint").alias("rank"))).alias("notes"),
    )
    kept = drift.evolve_union(first, second)
    note = F.col("notes")["ship"]
    return kept.select(
        "o_orderkey", "head.status", "head.price", "head.priority", F.size("steps").cast("bigint").alias("steps"),
        F.element_at("steps", -1)["text"].alias("last_step"), note["rank"].alias("rank"), note["year"].alias("year"),
    )


# ---- reconciliation and health -----------------------------------------------------------------

_COMPARE_SQL = f"""WITH a AS ({active_sql(DATES[1])}), b AS ({active_sql(DATES[0])})
SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, CASE WHEN b.o_custkey IS NULL THEN 'missing' WHEN a.o_custkey IS NULL THEN 'extra' ELSE 'changed' END AS outcome
FROM a FULL OUTER JOIN b ON a.o_custkey = b.o_custkey
WHERE a.o_custkey IS NULL OR b.o_custkey IS NULL OR a.order_count <> b.order_count OR a.total_spent <> b.total_spent OR a.last_order <> b.last_order"""


@query(
    "recon_rowcount",
    f"""WITH a AS ({active_sql(DATES[1])}), b AS ({active_sql(DATES[0])}) SELECT 'customers' AS table_name, (SELECT COUNT(*) FROM a) AS source_rows, (SELECT COUNT(*) FROM b) AS state_rows,
(SELECT COUNT(*) FROM a) - (SELECT COUNT(*) FROM b) AS difference, CASE WHEN (SELECT COUNT(*) FROM a) = (SELECT COUNT(*) FROM b) THEN 'match' ELSE 'mismatch' END AS status""",
)
def recon_rowcount(spark, sf):
    return reconcile.rowcount(snap(spark, sf, 1), snap(spark, sf, 0), "customers")


@query("recon_full_snapshot", _COMPARE_SQL)
def recon_full_snapshot(spark, sf):
    return reconcile.full_compare(snap(spark, sf, 1), snap(spark, sf, 0), KEY)


@query("recon_key_hash", _COMPARE_SQL)
def recon_key_hash(spark, sf):
    return reconcile.key_hash(snap(spark, sf, 1), snap(spark, sf, 0), KEY)


@query(
    "stale_watermarks",
    f"SELECT 'user_' || user_id AS table_name, MAX(ts) AS updated_at, COUNT(*) AS row_count FROM events GROUP BY user_id HAVING MAX(ts) < TIMESTAMP '{EVENTS_NOW}' - INTERVAL 24 HOUR",
)
def stale_watermarks(spark, sf):
    """Every user's event feed is taken as a table whose watermark is its newest event."""
    marks = Tables(spark, sf).events.groupBy("user_id").agg(F.max("ts").alias("updated_at"), F.count(F.lit(1)).alias("row_count"))
    named = marks.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"), "updated_at", "row_count")
    return health.stale_watermarks(named, at(EVENTS_NOW))


@query(
    "layer_row_counts",
    """SELECT 'bronze' AS layer, 'orders' AS table_name, (SELECT COUNT(*) FROM orders) AS row_count UNION ALL SELECT 'bronze', 'lineitem', (SELECT COUNT(*) FROM lineitem)
UNION ALL SELECT 'silver', 'lineitem', (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))""",
)
def layer_row_counts(spark, sf):
    t = Tables(spark, sf)
    return health.layer_row_counts(
        {
            ("bronze", "orders"): t.orders,
            ("bronze", "lineitem"): t.lineitem,
            ("silver", "lineitem"): t.lineitem.select("l_orderkey", "l_linenumber").distinct(),
        }
    )


@query(
    "data_freshness",
    f"""SELECT 'events' AS table_name, MAX(ts) AS latest_event, date_diff('second', MAX(ts), TIMESTAMP '{EVENTS_NOW}') // 60 AS lag_minutes FROM events
UNION ALL SELECT 'orders', MAX(o_orderdate), date_diff('second', MAX(o_orderdate), TIMESTAMP '{EVENTS_NOW}') // 60 FROM orders""",
)
def data_freshness(spark, sf):
    t = Tables(spark, sf)
    return health.freshness({"events": (t.events, "ts"), "orders": (t.orders, "o_orderdate")}, at(EVENTS_NOW))


@query(
    "sql_alert",
    """SELECT 'error_share' AS alert, v AS value, CASE WHEN v > 0.15 THEN 'TRIGGERED' ELSE 'OK' END AS state, v > 0.15 AS notify
FROM (SELECT ROUND(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) / COUNT(*), 6) AS v FROM events)""",
)
def sql_alert(spark, sf):
    share = F.round(F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)) / F.count(F.lit(1)), 6)
    return health.alert(Tables(spark, sf).events.agg(share.alias("v")), "error_share", "GREATER_THAN", 0.15)


# ---- history queries ---------------------------------------------------------------------------

_H = f"({HISTORY_SQL})"


@query("scd_current", f'SELECT * FROM {_H} WHERE "__END_AT" IS NULL')
def scd_current(spark, sf):
    return history.current(customer_history(spark, sf))


@query("scd_as_of", f"""SELECT * FROM {_H} WHERE "__START_AT" <= TIMESTAMP '1999-06-15' AND ("__END_AT" > TIMESTAMP '1999-06-15' OR "__END_AT" IS NULL)""")
def scd_as_of(spark, sf):
    return history.as_of(customer_history(spark, sf), at("1999-06-15"))


@query(
    "scd_entity_history",
    f"""SELECT o_custkey, order_count, "__START_AT", "__END_AT", CAST(date_diff('day', "__START_AT", COALESCE("__END_AT", TIMESTAMP '{ORDERS_NOW}')) AS INTEGER) AS days_active FROM {_H}""",
)
def scd_entity_history(spark, sf):
    return history.versions(customer_history(spark, sf), at(ORDERS_NOW)).select("o_custkey", "order_count", "__START_AT", "__END_AT", "days_active")


@query(
    "scd_changes_in_period",
    f"""SELECT o_custkey, "__START_AT" AS change_timestamp, 'UPDATE' AS change_type FROM (SELECT *, MIN("__START_AT") OVER (PARTITION BY o_custkey) AS f FROM {_H})
WHERE "__START_AT" BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31' AND "__START_AT" <> f""",
)
def scd_changes_in_period(spark, sf):
    got = history.changes_between(customer_history(spark, sf), KEY, at("1999-01-01"), at("1999-12-31"))
    return got.select("o_custkey", F.col("__START_AT").alias("change_timestamp"), "change_type")


@query("scd_recent_changes", f"""SELECT * FROM {_H} WHERE "__START_AT" >= TIMESTAMP '2000-02-15' - INTERVAL 90 DAY""")
def scd_recent_changes(spark, sf):
    return history.changed_since(customer_history(spark, sf), at("2000-02-15") - F.expr("INTERVAL 90 DAYS"))


@query(
    "scd_change_stats",
    f"""SELECT o_custkey, COUNT(*) AS version_count, MIN("__START_AT") AS first_seen, MAX("__START_AT") AS last_updated FROM {_H} GROUP BY o_custkey""",
)
def scd_change_stats(spark, sf):
    return history.change_stats(customer_history(spark, sf), KEY)


@query(
    "scd_standard_view",
    f"""SELECT o_custkey, order_count, total_spent, last_order, "__START_AT" AS valid_from, COALESCE("__END_AT", TIMESTAMP '9999-12-31') AS valid_to, "__END_AT" IS NULL AS is_current FROM {_H}""",
)
def scd_standard_view(spark, sf):
    return history.standard_view(customer_history(spark, sf))


@query(
    "scd_fact_asof",
    f"""SELECT o_orderkey, orders.o_custkey, o_orderdate, order_count, total_spent FROM orders JOIN {_H} h ON orders.o_custkey = h.o_custkey AND o_orderdate >= "__START_AT" AND (o_orderdate < "__END_AT" OR "__END_AT" IS NULL)""",
)
def scd_fact_asof(spark, sf):
    facts = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return history.join_as_of(facts, customer_history(spark, sf), KEY, "o_orderdate", ["order_count", "total_spent"])


@query(
    "scd_fact_current",
    f"""SELECT o_orderkey, orders.o_custkey, o_orderdate, order_count FROM orders JOIN {_H} h ON orders.o_custkey = h.o_custkey AND "__END_AT" IS NULL""",
)
def scd_fact_current(spark, sf):
    facts = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return history.join_current(facts, customer_history(spark, sf), KEY, ["order_count"])


PRICES_SQL = """(SELECT l_returnflag, l_linestatus, price, m AS price_start, lead(m) OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY m) AS price_end
FROM (SELECT l_returnflag, l_linestatus, date_trunc('month', l_shipdate)::TIMESTAMP AS m,
      ROUND(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE), 4) AS price FROM lineitem GROUP BY 1, 2, 3))"""


def price_history(spark, sf):
    """Price per unit of each class by month, valid until the class's next month; the window runs
    over one row per class and month."""
    from pyspark.sql import Window as W

    month = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")
    total = lambda c: F.sum(money(c)).cast("double")
    monthly = Tables(spark, sf).lineitem.groupBy("l_returnflag", "l_linestatus", month.alias("__START_AT")).agg(
        F.round(total("l_extendedprice") / total("l_quantity"), 4).alias("price")
    )
    per_class = W.partitionBy("l_returnflag", "l_linestatus").orderBy("__START_AT")
    return monthly.withColumn("__END_AT", F.lead("__START_AT").over(per_class))


@query(
    "join_temporal",
    f"""SELECT l.l_orderkey, l.l_linenumber, l.l_shipdate, l.l_quantity, p.price FROM lineitem l JOIN {PRICES_SQL} p ON l.l_returnflag = p.l_returnflag AND l.l_linestatus = p.l_linestatus
 AND l.l_shipdate >= p.price_start AND (l.l_shipdate < p.price_end OR p.price_end IS NULL)""",
)
def join_temporal(spark, sf):
    """Six keys only, so each holds a large part of the facts: the prices, a row a class and month, go to them."""
    facts = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag", "l_linestatus")
    got = history.join_as_of(facts, price_history(spark, sf), ["l_returnflag", "l_linestatus"], "l_shipdate", ["price"], short=True)
    return got.drop("l_returnflag", "l_linestatus")


@query(
    "join_current",
    f"""SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, p.price AS current_price FROM lineitem l JOIN {PRICES_SQL} p ON l.l_returnflag = p.l_returnflag AND l.l_linestatus = p.l_linestatus AND p.price_end IS NULL""",
)
def join_current(spark, sf):
    facts = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    got = history.join_current(facts, price_history(spark, sf), ["l_returnflag", "l_linestatus"], ["price"])
    return got.drop("l_returnflag", "l_linestatus").withColumnRenamed("price", "current_price")


@query(
    "join_multi_key_optional_price",
    f"""SELECT l.l_suppkey, l.l_returnflag, CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_units, ROUND(CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(p.price AS DECIMAL(18,4))) AS DOUBLE), 4) AS estimated
FROM lineitem l LEFT JOIN {PRICES_SQL} p ON l.l_returnflag = p.l_returnflag AND l.l_linestatus = p.l_linestatus WHERE p.price_end IS NULL GROUP BY l.l_suppkey, l.l_returnflag""",
)
def join_multi_key_optional_price(spark, sf):
    return priced_usage(spark, sf)


def priced_usage(spark, sf):
    """Usage times open price. Usage is summed by the join keys first, so the join meets one row
    per supplier and class; lines of classes that only have closed prices drop out."""
    usage = Tables(spark, sf).lineitem.groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(F.sum(money("l_quantity")).alias("q")).alias("u")
    prices = price_history(spark, sf).alias("p")
    on = (F.col("u.l_returnflag") == F.col("p.l_returnflag")) & (F.col("u.l_linestatus") == F.col("p.l_linestatus"))
    joined = usage.join(prices, on, "left").where(F.col("p.__END_AT").isNull())
    return joined.groupBy("u.l_suppkey", "u.l_returnflag").agg(
        F.sum("q").cast("double").alias("total_units"),
        F.round(F.sum(F.col("q") * F.col("price").cast("decimal(18,4)")).cast("double"), 4).alias("estimated"),
    )
