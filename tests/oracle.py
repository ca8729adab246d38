"""Runs a registered query and its SQL twin and compares the results."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return "<null>"
    if isinstance(v, float) and math.isnan(v):
        return "<nan>"
    if type(v).__name__ == "NaTType":
        return "<null>"
    if isinstance(v, dict):
        return str({k: _cell(x) for k, x in v.items()})
    if isinstance(v, (list, tuple)) or type(v).__name__ == "ndarray":
        return str([_cell(x) for x in v])
    if type(v).__name__ == "Row":
        return str(v.asDict(recursive=True))
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return f"b:{bool(v)}"
    if isinstance(v, float):
        return f"f:{v!r}"
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        v = v.replace(tzinfo=None)
    return f"{type(v).__name__}:{v}"


def normal(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def run_pair(spark, name: str, fn, sql: str | None, sf_dir: str, con=None) -> str | None:
    """None when equal, otherwise a short description of the difference."""
    df = fn(spark, sf_dir)
    cols, rows = normal(df.columns, df.collect())
    if sql is None:
        return None if rows else "no rows"
    con = con or connect(sf_dir)
    cur = con.execute(sql)
    ocols, orows = normal([d[0] for d in cur.description], cur.fetchall())
    if cols != ocols:
        return f"columns {cols} vs {ocols}"
    if len(rows) != len(orows):
        return f"rows {len(rows)} vs {len(orows)}"
    bad = [(a, b) for a, b in zip(rows, orows) if a != b]
    if bad:
        return f"{len(bad)} of {len(rows)} rows differ, e.g. {bad[0][0]} vs {bad[0][1]}"
    return None if rows else "both empty"
