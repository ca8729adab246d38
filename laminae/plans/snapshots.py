"""Versions of the given tables as they would have been delivered on past dates.

A load job sees one snapshot a day; here each is computed from the orders table: the customers with an
order before the date, with what they had ordered by then. The last date lies past the newest
order, so every order counts. A rule on key and year leaves some customers out of each snapshot,
so that between two dates customers appear, change, drop out and come back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminae.plans.registry import at, money

DATES = ["1998-01-01", "1999-01-01", "2002-01-01"]
LEFT_OUT = 11  # one customer in so many is missing from a snapshot


def active_customers(orders: DataFrame, date: str) -> DataFrame:
    present = (F.col("o_custkey") + int(date[:4])) % LEFT_OUT != 0
    return orders.where((F.col("o_orderdate") < at(date)) & present).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(money("o_totalprice")).cast("double").alias("total_spent"),
        F.max("o_orderdate").alias("last_order"),
    )


def active_sql(date: str) -> str:
    return f"""SELECT o_custkey, COUNT(*) AS order_count, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spent, MAX(o_orderdate) AS last_order
FROM orders WHERE o_orderdate < TIMESTAMP '{date}' AND (o_custkey + {int(date[:4])}) % {LEFT_OUT} <> 0 GROUP BY o_custkey"""


def history_sql(dates: list[str], tracked: list[str], values: list[str]) -> str:
    """Versions over a list of snapshots: a run of equal tracked values is one version, which shows
    the values of its last snapshot."""
    snaps = " UNION ALL ".join(f"SELECT {i} AS v, TIMESTAMP '{d}' AS taken, * FROM ({active_sql(d)})" for i, d in enumerate(dates))
    grid = " UNION ALL ".join(f"SELECT {i} AS v, TIMESTAMP '{d}' AS taken" for i, d in enumerate(dates))
    packed = "ROW(" + ", ".join(f"s.{c}" for c in tracked) + ")"
    return f"""WITH s AS ({snaps}), g AS ({grid}),
k AS (SELECT DISTINCT o_custkey FROM s),
f AS (SELECT k.o_custkey, g.v, g.taken, s.o_custkey IS NOT NULL AS present, {', '.join(f's.{c}' for c in values)}, CASE WHEN s.o_custkey IS NOT NULL THEN {packed} END AS t
      FROM k CROSS JOIN g LEFT JOIN s ON s.o_custkey = k.o_custkey AND s.v = g.v),
e AS (SELECT *, present AND (lag(t) OVER w IS DISTINCT FROM t) AS opens, present AND (lead(t) OVER w IS DISTINCT FROM t) AS closes, lead(taken) OVER w AS next_at FROM f WINDOW w AS (PARTITION BY o_custkey ORDER BY v)),
p AS (SELECT *, CASE WHEN opens THEN taken ELSE lag(taken) OVER (PARTITION BY o_custkey ORDER BY v) END AS start_at FROM e WHERE opens OR closes)
SELECT o_custkey, {', '.join(values)}, start_at AS "__START_AT", next_at AS "__END_AT" FROM p WHERE closes"""
