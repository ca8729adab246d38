"""Registered queries that write: sinks, file streams drained to the end, and the layered run.

Each works in a fresh folder below the session's shared one and returns what it reads back.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from laminae.config import load_contracts, table_contract
from laminae.operators import quality, scd
from laminae.operators.conform import conform
from laminae.plans import medallion
from laminae.plans.q_core import ROLLING_SQL
from laminae.plans.q_gold import _FACT_SQL
from laminae.plans.q_state import _LATEST_ORDER, SEQ, VALUES, cdc_history_sql, change_log, newest_sql
from laminae.plans.registry import EVENTS_NOW, Tables, at, query
from laminae.plans.snapshots import DATES, active_customers, active_sql
from laminae.session import cut_lineage, scratch_path
from laminae.sinks import tables as sink
from laminae.sinks import versions
from laminae.sources import files, logs
from laminae.sources.tables import above_watermark
from laminae.streaming import anomalies, basics, dedup
from laminae.streaming.cdc import ChangeState
from laminae.streaming.contract import ContractStream, late_rows

# ---- sources and sinks -------------------------------------------------------------------------


@query(
    "rescue_split",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, 'clean' AS part FROM events WHERE event_type <> 'error'
UNION ALL SELECT NULL, NULL, 'quarantine' FROM events WHERE event_type = 'error'""",
)
def rescue_split(spark, sf):
    """JSON lines of the events; the lines of error events lost their closing brace on the way."""
    e = Tables(spark, sf).events
    line = F.to_json(F.struct("event_id", F.from_json("props", "k INT")["k"].alias("k")))
    broken = F.expr("left(line, length(line) - 1)")
    path = scratch_path(spark, "rescue")
    lines = e.select(line.alias("line"), "event_type")
    lines.select(F.when(F.col("event_type") == "error", broken).otherwise(F.col("line")).alias("value")).write.text(path)
    parsed = cut_lineage(files.scan_rescued(spark, path, "json", "event_id BIGINT, k INT"), "bronze")
    clean, bad = files.split_rescued(parsed)
    shown = bad.select("event_id", "k", F.lit("quarantine").alias("part"))
    return clean.withColumn("part", F.lit("clean")).unionByName(shown)


@query("decode_envelope", "SELECT CAST(event_id AS VARCHAR) AS event_key, user_id, event_type, ts AS log_timestamp FROM events")
def decode_envelope(spark, sf):
    envelope = Tables(spark, sf).events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("user_id", "event_type")).cast("binary").alias("value"),
        F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )
    return logs.parse_json(logs.decode_envelope(envelope), "event_value", "user_id BIGINT, event_type STRING", ["event_key", "log_timestamp"])


@query("export_files", "SELECT o_orderkey, o_totalprice, 'parquet' AS fmt FROM orders UNION ALL SELECT o_orderkey, o_totalprice, 'csv' FROM orders")
def export_files(spark, sf):
    orders, base = Tables(spark, sf).orders.select("o_orderkey", "o_totalprice"), scratch_path(spark, "export")
    parts = []
    for fmt, options in (("parquet", {}), ("csv", {"header": "true"})):
        sink.export_files(orders, f"{base}/{fmt}", fmt)
        parts.append(files.scan_files(spark, f"{base}/{fmt}", fmt, orders.schema, **options).withColumn("fmt", F.lit(fmt)))
    return parts[0].unionByName(parts[1])


@query(
    "partitioned_output",
    "SELECT o_orderkey, r_name AS region FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def partitioned_output(spark, sf):
    """One folder per region from one job."""
    t, path = Tables(spark, sf), scratch_path(spark, "regions")
    located = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    sink.write_partitioned(located.select("o_orderkey", F.col("r_name").alias("region")), path, ["region"])
    return spark.read.parquet(path)


@query("layout_clustering", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def layout_clustering(spark, sf):
    path = scratch_path(spark, "clustered")
    sink.write_clustered(Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate"), path, ["o_custkey", "o_orderdate"])
    return spark.read.parquet(path)


@query("compact_small_files", "SELECT event_id, user_id, event_type FROM events")
def compact_small_files(spark, sf):
    base = scratch_path(spark, "compact")
    Tables(spark, sf).events.select("event_id", "user_id", "event_type").repartition(32).write.parquet(f"{base}/small")
    sink.compact(spark, f"{base}/small", f"{base}/large")
    return spark.read.parquet(f"{base}/large")


@query(
    "snapshot_audit",
    " UNION ALL ".join(f"SELECT {i} AS batch_id, * FROM ({active_sql(DATES[i])})" for i in (1, 2)),
)
def snapshot_audit(spark, sf):
    """Three yearly snapshots kept for two years: the oldest has expired."""
    path = scratch_path(spark, "audit")
    for i, day in enumerate(DATES):
        versions.append_audit(active_customers(Tables(spark, sf).orders, day), path, i, day)
    versions.expire_audit(spark, path, "2000-12-15", 2 * 365)
    return spark.read.parquet(path).select(F.col("_batch_id").alias("batch_id"), "o_custkey", *VALUES)


# ---- streams -----------------------------------------------------------------------------------


def feed(spark, df, label: str, parts: int = 3):
    """The frame as a file stream of deliveries in no order of time. Each has the files that its tasks wrote, and a
    batch takes as many files as a delivery has, so batches are read by as many tasks as the input."""
    path = scratch_path(spark, label)
    for i in range(parts):
        df.where(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == i).write.parquet(f"{path}/{i}")
    largest = max(len(spark.read.schema(df.schema).parquet(f"{path}/{i}").inputFiles()) for i in range(parts))
    return files.stream_files(spark, f"{path}/*", schema=df.schema, max_files_per_trigger=max(1, largest))


def drained(spark, stream, label: str):
    out = scratch_path(spark, label)
    basics.write_batches(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data").drop("_batch_id")


@query("stream_files", "SELECT event_id, user_id, event_type, ts FROM events")
def stream_files(spark, sf):
    rows = Tables(spark, sf).events.select("event_id", "user_id", "event_type", "ts")
    return drained(spark, feed(spark, rows, "feed"), "stream")


@query("cdc_raw_append", "SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN 'd' ELSE 'u' END AS op FROM events")
def cdc_raw_append(spark, sf):
    rows = change_log(spark, sf).select("event_id", "user_id", "ts", "op")
    return drained(spark, feed(spark, rows, "feed"), "raw")


STREAM_RULES = [quality.Rule("valued", "value > 20", "warn"), quality.Rule("no_signup", "event_type <> 'signup'", "drop")]
STREAM_STEPS = [{"type": "trim_strings"}, {"type": "add_column", "name": "kind", "expression": "upper(event_type)"}]


@query("silver_stream", "SELECT event_id, value, upper(trim(event_type)) AS kind, TRUE AS _is_current FROM events WHERE event_type <> 'signup'")
def silver_stream(spark, sf):
    stream = feed(spark, Tables(spark, sf).events.select("event_id", "event_type", "value"), "feed")
    shaped = quality.apply_rules(conform(stream, STREAM_STEPS, EVENTS_NOW), STREAM_RULES)
    return drained(spark, shaped.select("event_id", "value", "kind", "_is_current"), "silver")


@query("quarantine_stream", "SELECT event_id, value, 'valued' AS _quarantine_expectations FROM events WHERE NOT (value > 20)")
def quarantine_stream(spark, sf):
    stream = feed(spark, Tables(spark, sf).events.select("event_id", "event_type", "value"), "feed")
    held = quality.quarantine(conform(stream, STREAM_STEPS, EVENTS_NOW), STREAM_RULES, EVENTS_NOW)
    return drained(spark, held.select("event_id", "value", "_quarantine_expectations"), "quarantine")


@query("st_out_of_order_scd2", cdc_history_sql(["event_type", "value", "props"], ["ts", "event_id", "event_type", "value", "props"]))
def st_out_of_order_scd2(spark, sf):
    """History kept from a stream whose parts arrive in no order of time."""
    state = ChangeState(spark, scratch_path(spark, "state"), ["user_id"], SEQ, scd.is_delete("op"), ["op"])
    state.start(feed(spark, change_log(spark, sf), "feed")).awaitTermination()
    state.refresh_history()
    return state.stored_history()


@query("st_anomaly_route", f"SELECT event_id, user_id, value, CASE WHEN value > a + 3 * s THEN 'HIGH_OUTLIER' ELSE 'LOW_OUTLIER' END AS anomaly_flag FROM ({ROLLING_SQL}) WHERE value > a + 3 * s OR value < a - 3 * s")
def st_anomaly_route(spark, sf):
    """Outliers routed by a stream that reads the log in order of time."""
    rows = Tables(spark, sf).events.select("user_id", "ts", "event_id", "value")
    path = scratch_path(spark, "anomaly")
    # two deliveries, parted at the median time and open at both ends
    middle = F.lit(rows.agg(F.percentile_approx("ts", 0.5)).head()[0]).cast("timestamp_ntz")
    later = F.coalesce(F.col("ts") >= middle, F.lit(False))
    for i, part in enumerate([~later, later]):
        rows.where(part).write.parquet(f"{path}/in/{i}")
        stream = files.stream_files(spark, f"{path}/in/*", schema=rows.schema)
        anomalies.route(stream, ["user_id"], ["ts", "event_id"], "value", f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out/alerts").select("event_id", "user_id", "value", "anomaly_flag")


@query("st_recovery", "SELECT event_id, user_id FROM events")
def st_recovery(spark, sf):
    """A second start from the same checkpoint adds nothing."""
    stream, out = feed(spark, Tables(spark, sf).events.select("event_id", "user_id"), "feed"), scratch_path(spark, "recovery")
    for _ in range(2):
        basics.append_files(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data")


_STREAMED = "SELECT event_id, event_type, value, CASE WHEN event_id % 2 = 1 THEN props END AS props FROM events WHERE event_type <> 'signup'"


@query("medallion_stream", _STREAMED)
def medallion_stream(spark, sf):
    """A stream run from its contract: two starts, a rate of two files a batch, and a column that comes with the second."""
    base, e = scratch_path(spark, "streamed"), Tables(spark, sf).events
    doc = {"target_name": "events", "source": "files", "source_schema": "samples", "source_table": "events"}
    load = {"strategy": "stream", "stream": {"max_offsets_per_trigger": 2}}
    rules = [{"name": "valued", "constraint": "value > 20"}, {"name": "no_signup", "constraint": "event_type <> 'signup'", "action": "drop"}]
    c = table_contract({**doc, "load": load, "quality": {"expectations": rules}, "schema_drift": {"alert_on_drift": False}})
    for odd, columns in enumerate((["event_id", "event_type", "value"], ["event_id", "event_type", "value", "props"])):
        e.where(F.col("event_id") % 2 == odd).select(*columns).write.parquet(f"{base}/in/{odd}")
        stream = ContractStream(spark, c, f"{base}/in/*", base)
        stream.start(at=EVENTS_NOW).awaitTermination()
    return stream.rows().select("event_id", "event_type", "value", "props")


@query(
    "stream_quality",
    """SELECT 'events' AS table_name, 'valued' AS rule_name, 'warn' AS action, COUNT(*) FILTER (WHERE value > 20) AS passed, COUNT(*) FILTER (WHERE NOT COALESCE(value > 20, FALSE)) AS failed FROM events
UNION ALL SELECT 'events', 'no_signup', 'drop', COUNT(*) FILTER (WHERE event_type <> 'signup'), COUNT(*) FILTER (WHERE NOT COALESCE(event_type <> 'signup', FALSE)) FROM events""",
)
def stream_quality(spark, sf):
    """Pass rates of a stream's rules, measured while its batches are written."""
    base, e = scratch_path(spark, "measured"), Tables(spark, sf).events.select("event_id", "event_type", "value")
    rules = [{"name": "valued", "constraint": "value > 20"}, {"name": "no_signup", "constraint": "event_type <> 'signup'", "action": "drop"}]
    doc = {"target_name": "events", "source": "files", "source_schema": "samples", "source_table": "events"}
    c = table_contract({**doc, "load": {"strategy": "stream"}, "quality": {"expectations": rules}})
    e.write.parquet(f"{base}/in/0")
    stream = ContractStream(spark, c, f"{base}/in/*", base)
    stream.start(at=EVENTS_NOW).awaitTermination()
    return stream.quality()


_LATE = "(SELECT date_trunc('millisecond', MAX(ts)) - INTERVAL 1 HOUR FROM events WHERE event_id % 2 = 0)"


@query("st_late_data", f"SELECT COUNT(*) FILTER (WHERE event_id % 2 = 0 OR ts > {_LATE}) AS kept, COUNT(*) FILTER (WHERE event_id % 2 = 1 AND ts <= {_LATE}) AS dropped FROM events")
def st_late_data(spark, sf):
    """Events of which half come after the watermark has passed most of them: what a stream keeps, and what its state
    operators say that they dropped."""
    base, e = scratch_path(spark, "late"), Tables(spark, sf).events.select("event_id", "ts")
    dropped = 0
    for odd in (0, 1):
        e.where(F.col("event_id") % 2 == odd).write.parquet(f"{base}/in/{odd}")
        stream = dedup.by_key(files.stream_files(spark, f"{base}/in/*", schema=e.schema), ["event_id"], "ts", "1 hour")
        query = basics.append_files(stream, f"{base}/out", f"{base}/checkpoint")
        query.awaitTermination()
        dropped += late_rows(query)
    return spark.read.parquet(f"{base}/out").agg(F.count(F.lit(1)).alias("kept"), F.lit(dropped).cast("long").alias("dropped"))


# ---- end to end --------------------------------------------------------------------------------


@query("medallion_run", _FACT_SQL)
def medallion_run(spark, sf):
    """All layers over all tables by the packaged contracts; returns the fact table it wrote."""
    base, t = scratch_path(spark, "layers"), Tables(spark, sf)
    medallion.medallion_run(spark, base, load_contracts(), lambda c, _: getattr(t, c.source_table), datetime(2024, 1, 31))
    return versions.read_version(spark, f"{base}/gold/fact_order_line")


def contract(name: str, **load):
    """Contract of one table that is loaded by the journal."""
    return table_contract({"target_name": name, "source": "files", "source_schema": "samples", "source_table": name, "load": load})


def deliveries(spark, c, frames, died=()):
    """Runs bronze and silver once for each delivery, in a fresh lake; returns what silver holds. In the runs named
    in `died` only the raw batch gets written, as if the run had died there."""
    base = scratch_path(spark, "lake")
    for day, df in enumerate(frames):
        read = lambda c, mark: above_watermark(df, c.watermark_column, mark) if c.watermark_column and mark else df  # noqa: B023, E731
        run = medallion.Run(spark, base, read, datetime(2024, 2, 1 + day))
        if day in died:
            medallion.land(run, c, medallion.recover(run, c))
        else:
            medallion.medallion_run(spark, base, [c], read, run.at, models=[])
    return versions.read_version(spark, f"{base}/silver/{c.target_name}")


def log_parts(spark, sf, n):
    """The change log in n deliveries that overlap in time: every key has late events."""
    log = change_log(spark, sf)
    return [log.where(F.pmod(F.xxhash64("event_id"), F.lit(n)) == i) for i in range(n)]


@query("medallion_cdc_scd1", newest_sql("ts"))
def medallion_cdc_scd1(spark, sf):
    """Current rows through the layers, from three deliveries out of order; the second run dies."""
    c = contract("users", strategy="cdc", primary_key=["user_id"], sequence_by_column="ts")
    return deliveries(spark, c, log_parts(spark, sf, 3), died={1}).select("user_id", "ts", "event_id", "event_type", "value", "props")


@query("medallion_cdc_scd2", cdc_history_sql(["event_id", "event_type", "value", "props"], ["ts", "event_id", "event_type", "value", "props"]))
def medallion_cdc_scd2(spark, sf):
    """Histories through the layers, likewise."""
    c = contract("users", strategy="cdc", primary_key=["user_id"], sequence_by_column="ts", stored_as_scd_type=2)
    kept = deliveries(spark, c, log_parts(spark, sf, 3), died={1})
    return kept.select("user_id", "ts", "event_id", "event_type", "value", "props", scd.START, scd.END)


CUTS = ["1997-01-01", "1999-01-01", "2002-01-01"]


def orders_so_far(spark, sf):
    """The orders table as it stood on past dates."""
    orders = Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    newest = orders.agg(F.max("o_orderdate")).head()[0]
    return [orders.where(F.col("o_orderdate") <= F.least(at(cut), F.lit(newest))) for cut in CUTS[:-1]] + [orders]


@query("medallion_incremental", _LATEST_ORDER)
def medallion_incremental(spark, sf):
    """Newest order of each customer, from increments above the confirmed watermark; the second run dies."""
    orders = [df.withColumn("at", F.struct("o_orderdate", "o_orderkey")) for df in orders_so_far(spark, sf)]
    c = contract("orders", strategy="incremental", primary_key=["o_custkey"], watermark_column="o_orderdate", sequence_by_column="at")
    return deliveries(spark, c, orders, died={1}).select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")


@query("medallion_incremental_raw", "SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders")
def medallion_incremental_raw(spark, sf):
    """Increments without a key: every row is there once, though the second run dies."""
    c = contract("orders", strategy="incremental", watermark_column="o_orderdate")
    return deliveries(spark, c, orders_so_far(spark, sf), died={1}).select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
