"""Streams equal their batch twins; late data, restarts and replays."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from laminae.operators import quality, scd
from laminae.operators.conform import conform
from laminae.sources import files, logs
from laminae.streaming import anomalies, basics, dedup, joins, windows
from laminae.streaming.cdc import ChangeState

SF = "/root/testdata/sf0.001"


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


@pytest.fixture
def feed(spark, run_dir, events):
    """The events as three files in time order, read as a stream of one file per batch."""
    src = f"{run_dir}/in"
    for i, (lo, hi) in enumerate([("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]):
        part = events.where((F.col("ts") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("ts") < F.lit(hi).cast("timestamp_ntz")))
        part.coalesce(1).write.mode("append").parquet(src)
    return lambda: files.stream_files(spark, src, schema=events.schema, max_files_per_trigger=1)


def drain(spark, df, run_dir, name, output_mode="append"):
    q = basics.write_batches(df, f"{run_dir}/{name}", f"{run_dir}/ck-{name}", output_mode=output_mode)
    q.awaitTermination(120)
    assert q.exception() is None
    return spark.read.parquet(f"{run_dir}/{name}").drop("_batch_id")


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def closed(batch, column, events, size, delay):
    """Windows a stream has emitted when it ends: those before the final watermark."""
    top = events.agg(F.max("ts").alias("m")).head().m - delay
    return batch.where(F.col(column) + F.expr(f"INTERVAL {size}") <= F.lit(top).cast("timestamp"))


def test_tumbling_equals_batch(spark, run_dir, feed, events):
    aggs = [F.count(F.lit(1)).alias("n"), F.max("value").alias("m")]
    got = drain(spark, windows.tumbling(feed(), "ts", "5 minutes", ["event_type"], aggs), run_dir, "tumble")
    want = closed(windows.tumbling(events, "ts", "5 minutes", ["event_type"], aggs), "window_start", events, "5 MINUTES", timedelta(minutes=10))
    assert rows(got) == rows(want) and got.count() > 0


def test_sessions_equal_batch(spark, run_dir, feed, events):
    got = drain(spark, windows.session(feed(), "ts", ["user_id"]), run_dir, "session")
    want = closed(windows.session(events, "ts", ["user_id"]), "session_end", events, "30 MINUTES", timedelta(minutes=10))
    assert rows(got) == rows(want) and got.count() > 0


def test_daily_and_lag_and_multi(spark, run_dir, feed, events):
    n = [F.count(F.lit(1)).alias("n")]
    got = drain(spark, windows.daily(feed(), "ts", n), run_dir, "daily")
    assert set(rows(got)) <= set(rows(windows.daily(events, "ts", n))) and got.count() >= 27
    now = F.lit("2024-01-31").cast("timestamp")
    lag = drain(spark, windows.lag_monitor(feed(), "ts", "events", now), run_dir, "lag")
    assert set(rows(lag)) <= set(rows(windows.lag_monitor(events, "ts", "events", now)))
    parts = windows.multi(feed(), "ts", {"1 minute": n, "1 hour": n}, ["event_type"])
    assert all(drain(spark, df, run_dir, size.replace(" ", "")).count() > 0 for size, df in parts.items())


def test_running_totals_update(spark, run_dir, feed, events):
    aggs = [F.count(F.lit(1)).alias("n")]
    got = drain(spark, windows.running_totals(feed(), ["user_id"], aggs), run_dir, "totals", "complete")
    final = got.groupBy("user_id").agg(F.max("n").alias("n"))
    assert rows(final) == rows(windows.running_totals(events, ["user_id"], aggs))


def test_dedup_by_key(spark, run_dir, feed, events):
    doubled = basics.fan_in([feed(), feed()])
    got = drain(spark, dedup.by_key(doubled, ["event_id"], "ts", "40 days"), run_dir, "dedup")
    assert got.count() == events.count() == dedup.by_key(events.union(events), ["event_id"], "ts").count()


def test_dedup_in_window_and_composite(spark, run_dir, feed):
    twice = basics.fan_in([feed(), feed()]).withColumn("arrived", F.col("ts"))
    got = drain(spark, dedup.in_window(twice, ["event_id", "user_id"], "ts", "arrived", delay="40 days"), run_dir, "win", "complete")
    assert got.groupBy("event_id").count().where("count > 3").isEmpty()
    got = drain(spark, dedup.composite(twice, ["user_id", "event_type"], "ts", "arrived", "1 hour"), run_dir, "comp")
    assert got.groupBy("user_id", "event_type", "ts").count().where("count > 1").isEmpty()


def test_late_rows_beyond_the_watermark_are_dropped(spark, run_dir):
    src, ddl = f"{run_dir}/late", "ts timestamp, n int"
    base = datetime(2024, 1, 1, 12)
    deliveries = [[(base, 1)], [(base + timedelta(hours=5), 2)], [(base + timedelta(minutes=1), 3)], [(base + timedelta(hours=4, minutes=50), 4)], [(base + timedelta(hours=9), 5)], [(base + timedelta(hours=9), 6)]]
    stream = files.stream_files(spark, src + "/*", schema=ddl, max_files_per_trigger=1)
    for i, d in enumerate(deliveries):
        spark.createDataFrame(d, ddl).coalesce(1).write.parquet(f"{src}/{i}")
        q = basics.write_batches(windows.tumbling(stream, "ts", "1 hour", [], [F.sum("n").alias("s")], "30 minutes"), f"{run_dir}/out", f"{run_dir}/ck")
        q.awaitTermination(60)
    got = {r.window_start.hour: r.s for r in spark.read.parquet(f"{run_dir}/out").collect()}
    assert got[12] == 1  # the row 3 came too late
    assert got[16] == 4  # the row 4 was late but within the delay


def test_interval_join_equals_batch(spark, run_dir, feed, events):
    def sides(df):
        pick = lambda kind, key, ts: df.where(F.col("event_type") == kind).select("user_id", F.col("event_id").alias(key), F.col("ts").alias(ts))
        return pick("view", "a", "ats"), pick("click", "b", "bts")

    want = joins.interval(*sides(events), "user_id", "ats", "bts", hours=3)
    l, _ = sides(feed())
    _, r = sides(feed())
    got = drain(spark, joins.interval(l, r, "user_id", "ats", "bts", hours=3, delay="40 days"), run_dir, "pairs")
    assert rows(got) == rows(want) and got.count() > 0
    x, y = sides(events)
    plain = x.join(y, "user_id").where("bts BETWEEN ats AND ats + INTERVAL 3 HOURS")
    assert want.count() == plain.count()


def test_static_join(spark, run_dir, feed, events):
    dim = spark.read.parquet(f"{SF}/customer.parquet")
    on = F.col("user_id") == F.col("c_custkey")
    got = drain(spark, joins.with_dimension(feed(), dim, on, ["c_custkey", "c_name"]), run_dir, "static")
    assert rows(got) == rows(joins.with_dimension(events, dim, on, ["c_custkey", "c_name"]))


def test_silver_and_quarantine_streams(spark, run_dir, feed, events):
    rules = [quality.Rule("valued", "value > 20", "warn"), quality.Rule("typed", "event_type <> 'signup'", "drop")]
    shape = lambda df: conform(df, [{"type": "trim_strings"}], at="2024-01-01")
    good = drain(spark, quality.apply_rules(shape(feed()), rules), run_dir, "silver")
    assert rows(good) == rows(quality.apply_rules(shape(events), rules))
    bad = drain(spark, quality.quarantine(shape(feed()), rules, "2024-01-01"), run_dir, "quarantine")
    assert rows(bad) == rows(quality.quarantine(shape(events), rules, "2024-01-01")) and bad.count() > 0


def test_failing_rule_stops_the_stream(spark, run_dir, feed):
    q = basics.write_batches(quality.apply_rules(feed(), [quality.Rule("none", "value < 0", "fail")]), f"{run_dir}/x", f"{run_dir}/ckx")
    with pytest.raises(Exception, match="expectation failed: none"):
        q.awaitTermination(60)


def change_feed(df):
    return df.withColumn("op", F.when(F.col("event_type") == "error", "d").otherwise("u"))


def test_change_state_type1_type2_compaction_and_restart(spark, run_dir, events):
    src = f"{run_dir}/cdc"
    log = change_feed(events)
    # Delivered out of order: by a hash of the id, not by time.
    pieces = [log.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i) for i in (2, 0, 1)]
    state = ChangeState(spark, f"{run_dir}/state", ["user_id"], ["ts", "event_id"], scd.is_delete("op"), ["op"])
    for i, piece in enumerate(pieces):
        piece.coalesce(1).write.parquet(f"{src}/{i}")
        stream = files.stream_files(spark, src + "/*", schema=log.schema)
        state.start(stream).awaitTermination(60)  # each start resumes from the checkpoint
        state.refresh_history()
        if i == 1:
            state.compact()
    want1 = scd.cdc_scd1(log, ["user_id"], ["ts", "event_id"], scd.is_delete("op"), ["op"])
    want2 = scd.cdc_scd2(log, ["user_id"], ["ts", "event_id"], scd.is_delete("op"), ["op"])
    assert rows(state.current()) == rows(want1)
    assert rows(state.history()) == rows(want2)
    assert rows(state.stored_history()) == rows(want2)
    before = state.newest_batch()
    state.start(files.stream_files(spark, src + "/*", schema=log.schema)).awaitTermination(60)
    assert state.newest_batch() == before and rows(state.current()) == rows(want1)


def test_backfill_joins_a_running_change_state(spark, run_dir, events):
    """Earlier events that come as one load, before or after batches, compaction and history."""
    log = change_feed(events)
    late, now = log.where("event_id % 3 = 0"), log.where("event_id % 3 <> 0")
    state = ChangeState(spark, f"{run_dir}/state", ["user_id"], ["ts", "event_id"], scd.is_delete("op"), ["op"])
    now.coalesce(1).write.parquet(f"{run_dir}/in/0")
    state.start(files.stream_files(spark, f"{run_dir}/in/*", schema=log.schema)).awaitTermination(60)
    state.compact()
    state.refresh_history()
    assert state.backfill(late, "old") and not state.backfill(late, "old")
    state.refresh_history()
    want1 = scd.cdc_scd1(log, ["user_id"], ["ts", "event_id"], scd.is_delete("op"), ["op"])
    want2 = scd.cdc_scd2(log, ["user_id"], ["ts", "event_id"], scd.is_delete("op"), ["op"])
    assert rows(state.current()) == rows(want1) and rows(state.stored_history()) == rows(want2)
    first = ChangeState(spark, f"{run_dir}/first", ["user_id"], ["ts", "event_id"], scd.is_delete("op"), ["op"])
    first.backfill(log, "all")
    first.compact()
    first.refresh_history()
    assert rows(first.current()) == rows(want1) and rows(first.stored_history()) == rows(want2)


def test_repeated_batch_adds_nothing(spark, run_dir, events):
    for _ in range(2):
        events.write.mode("overwrite").parquet(f"{run_dir}/out/_batch_id=0")
    assert spark.read.parquet(f"{run_dir}/out").count() == events.count()
    assert basics.backfill_once(events, f"{run_dir}/out", "old") is True
    assert basics.backfill_once(events, f"{run_dir}/out", "old") is False
    assert spark.read.parquet(f"{run_dir}/out").count() == 2 * events.count()


def test_file_sink_and_rocksdb(spark, run_dir, feed, events):
    key = "spark.sql.streaming.stateStore.providerClass"
    basics.use_rocksdb(spark)
    try:
        got = drain(spark, windows.tumbling(feed(), "ts", "1 hour", ["event_type"], [F.count(F.lit(1)).alias("n")]), run_dir, "rocks")
    finally:
        spark.conf.unset(key)
    assert got.count() > 0
    basics.append_files(feed(), f"{run_dir}/files", f"{run_dir}/ckf").awaitTermination(60)
    assert spark.read.parquet(f"{run_dir}/files").count() == events.count()


def test_anomaly_routing_equals_batch(spark, run_dir, feed, events):
    cols = ["user_id", "ts", "event_id", "value"]
    q = anomalies.route(feed().select(*cols), ["user_id"], ["ts", "event_id"], "value", f"{run_dir}/a", f"{run_dir}/cka")
    q.awaitTermination(120)
    got = spark.read.parquet(f"{run_dir}/a/alerts").drop("_batch_id")
    want = anomalies.flagged(events.select(*cols), ["user_id"], ["ts", "event_id"], "value").where("anomaly_flag <> 'NORMAL'")
    assert rows(got) == rows(want) and got.count() > 0


def test_triggers():
    assert basics.trigger_options("triggered") == {"availableNow": True}
    assert basics.trigger_options("continuous", "10 seconds") == {"processingTime": "10 seconds"}
    with pytest.raises(ValueError):
        basics.trigger_options("sometimes")


def test_log_envelope_from_files(spark, run_dir, events):
    """Envelopes with the log's columns go through the same decoding as a broker's."""
    envelope = events.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("event_id", "user_id", F.col("props"))).cast("binary").alias("value"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
    )
    assert envelope.columns == logs.LOG_COLUMNS
    envelope.write.parquet(f"{run_dir}/log")
    stream = files.stream_files(spark, f"{run_dir}/log", schema=envelope.schema)
    flat = logs.parse_json(logs.decode_envelope(stream), "event_value", "event_id BIGINT, user_id BIGINT, props STRING")
    got = drain(spark, flat, run_dir, "flat").select("event_id", "user_id", "props")
    assert rows(got) == rows(events.select("event_id", "user_id", "props"))
