"""Registered queries: batch twins of the streaming operators, on the same functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from laminae.operators import ordered
from laminae.plans.registry import EVENTS_NOW, Tables, at, money, query
from laminae.sources.tables import wall_clock
from laminae.streaming import basics, dedup, joins, windows


def wall(df, *columns):
    return df.withColumns({c: wall_clock(c) for c in columns})


def repeated_events(spark, sf):
    """The event log with its purchases delivered twice, the second time an hour later."""
    e = Tables(spark, sf).events
    first = e.withColumn("arrived", F.col("ts"))
    again = e.where(F.col("event_type") == "purchase").withColumn("arrived", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    return first.unionByName(again)


@query("st_dedup_key", "SELECT event_id, user_id, event_type, ts FROM events")
def st_dedup_key(spark, sf):
    rows = repeated_events(spark, sf).select("event_id", "user_id", "event_type", "ts")
    return dedup.by_key(rows, ["event_id"], "ts")


@query("st_dedup_window", "SELECT event_id, user_id, event_type, ts, ts AS first_seen_at FROM events")
def st_dedup_window(spark, sf):
    got = dedup.in_window(repeated_events(spark, sf), ["event_id", "user_id", "event_type"], "ts", "arrived")
    return wall(got, "ts")


@query("st_dedup_composite", "SELECT user_id, event_type, value, ts, MIN(ts) AS arrived FROM events GROUP BY 1, 2, 3, 4")
def st_dedup_composite(spark, sf):
    got = dedup.composite(repeated_events(spark, sf), ["user_id", "event_type", "value"], "ts", "arrived")
    return wall(got, "ts")


def _bucket_sql(size: str, step: str, extra: str, keys: str = "event_type") -> str:
    start = f"time_bucket(INTERVAL {size}, ts, TIMESTAMP '1970-01-01')"
    return f"SELECT {keys}, {start} AS window_start, {start} + INTERVAL {step} AS window_end, {extra} FROM events GROUP BY ALL"


_STATS = "CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS avg_value, MIN(value) AS min_value, MAX(value) AS max_value, COUNT(*) AS event_count"


def stats():
    return [
        (F.sum(money("value")).cast("double") / F.count(F.lit(1))).alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count(F.lit(1)).alias("event_count"),
    ]


@query("st_tumbling", _bucket_sql("5 MINUTE", "5 MINUTE", _STATS))
def st_tumbling(spark, sf):
    got = windows.tumbling(Tables(spark, sf).events, "ts", "5 minutes", ["event_type"], stats())
    return wall(got, "window_start", "window_end")


@query(
    "st_multi_window",
    " UNION ALL ".join(
        f"SELECT '{label}' AS size, event_type, window_start, event_count FROM ({_bucket_sql(size, size, 'COUNT(*) AS event_count')})"
        for label, size in (("1 minute", "1 MINUTE"), ("1 hour", "1 HOUR"))
    ),
)
def st_multi_window(spark, sf):
    count = [F.count(F.lit(1)).alias("event_count")]
    parts = windows.multi(Tables(spark, sf).events, "ts", {"1 minute": count, "1 hour": count}, ["event_type"])
    named = [df.select(F.lit(size).alias("size"), "event_type", wall_clock("window_start").alias("window_start"), "event_count") for size, df in parts.items()]
    return basics.fan_in(named)


@query(
    "st_session",
    """WITH m AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, SUM(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM m)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS event_count FROM n GROUP BY user_id, no""",
)
def st_session(spark, sf):
    """Batch sessions by the segmented scan, which divides a very active user over days."""
    e = Tables(spark, sf).events.select("user_id", "ts", "event_id")
    marked = ordered.sessions(e, ["user_id"], "ts", "event_id", 30 * 60, ordered.day_segment("ts"))
    return marked.groupBy("user_id", "_session").agg(
        F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count(F.lit(1)).alias("event_count")
    ).drop("_session")


@query("st_event_time_daily", "SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS n, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1")
def st_event_time_daily(spark, sf):
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    return windows.daily(Tables(spark, sf).events, "ts", [F.count(F.lit(1)).alias("n"), total])


@query(
    "st_lag_monitor",
    f"""SELECT 'events' AS source, date_trunc('minute', ts)::TIMESTAMP AS window_start, MAX(ts) AS max_event_timestamp, CAST(epoch(TIMESTAMP '{EVENTS_NOW}') AS BIGINT) - CAST(floor(epoch(MAX(ts))) AS BIGINT) AS lag_seconds FROM events GROUP BY 2""",
)
def st_lag_monitor(spark, sf):
    return wall(windows.lag_monitor(Tables(spark, sf).events, "ts", "events", at(EVENTS_NOW)), "window_start", "max_event_timestamp")


@query("st_running_totals", "SELECT user_id, COUNT(*) AS n, MAX(ts) AS last_at FROM events GROUP BY user_id")
def st_running_totals(spark, sf):
    return windows.running_totals(Tables(spark, sf).events, ["user_id"], [F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_at")])


@query("st_bounded_state", "SELECT user_id, date_trunc('hour', ts)::TIMESTAMP AS window_start, COUNT(*) AS n FROM events GROUP BY 1, 2")
def st_bounded_state(spark, sf):
    got = windows.tumbling(Tables(spark, sf).events, "ts", "1 hour", ["user_id"], [F.count(F.lit(1)).alias("n")])
    return wall(got, "window_start").drop("window_end")


@query(
    "st_fan_in_backfill",
    "SELECT event_id AS id, ts AS at, 'event' AS origin FROM events UNION ALL SELECT o_orderkey, o_orderdate, 'order' FROM orders",
)
def st_fan_in_backfill(spark, sf):
    t = Tables(spark, sf)
    side = lambda df, key, ts, origin: df.select(F.col(key).alias("id"), F.col(ts).alias("at"), F.lit(origin).alias("origin"))
    return basics.fan_in([side(t.events, "event_id", "ts", "event"), side(t.orders, "o_orderkey", "o_orderdate", "order")])


@query(
    "join_stream_static",
    "SELECT event_id, user_id, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey",
)
def join_stream_static(spark, sf):
    t = Tables(spark, sf)
    on = F.col("user_id") == F.col("c_custkey")
    got = joins.with_dimension(t.events.select("event_id", "user_id"), t.customer, on, ["c_custkey", "c_name", "c_mktsegment"])
    return got.drop("c_custkey")


@query(
    "join_stream_stream",
    """SELECT a.user_id, a.event_id AS view_id, a.ts AS viewed_at, b.event_id AS purchase_id, b.ts AS bought_at FROM events a JOIN events b ON a.user_id = b.user_id AND b.ts BETWEEN a.ts AND a.ts + INTERVAL 1 HOUR
WHERE a.event_type = 'view' AND b.event_type = 'purchase'""",
)
def join_stream_stream(spark, sf):
    e = Tables(spark, sf).events
    side = lambda kind, key, ts: e.where(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(key), F.col("ts").alias(ts))
    got = joins.interval(side("view", "view_id", "viewed_at"), side("purchase", "purchase_id", "bought_at"), "user_id", "viewed_at", "bought_at")
    return wall(got, "viewed_at", "bought_at")
