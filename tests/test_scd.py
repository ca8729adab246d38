"""Keyed state: hand-made cases, brute force and properties."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from laminae.operators import changes, scd
from laminae.operators.ordered import celled, day_segment, exact_percentiles, rolling, sessions, with_neighbours, with_positions

DAY0 = datetime(2024, 1, 1)
LOG_DDL = "k int, ts timestamp_ntz, n int, a string, b string, op string"


def log_rows(events):
    """(key, hour, a, b, deleted) to rows with a unique sequence number."""
    return [(k, DAY0 + timedelta(hours=h), i, a, b, "D" if d else "u") for i, (k, h, a, b, d) in enumerate(events)]


def brute_history(rows, track):
    """Reference: walk each key's events in order."""
    out = []
    for key in {r[0] for r in rows}:
        version = None
        for _, ts, n, a, b, op in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            now = {"a": a, "b": b}
            if op == "D":
                if version:
                    out.append((*version, ts))
                version = None
            elif version and all(version[1][c] == now[c] for c in track):
                version = (key, now, version[2])
            else:
                if version:
                    out.append((*version, ts))
                version = (key, now, ts)
        if version:
            out.append((*version, None))
    return sorted((k, v["a"], v["b"], s, e) for k, v, s, e in out) if all(x[3] for x in out) else sorted(
        ((k, v["a"], v["b"], s, e) for k, v, s, e in out), key=str
    )


def spark_history(spark, rows, track=None):
    log = spark.createDataFrame(rows, LOG_DDL)
    got = scd.cdc_scd2(log, ["k"], ["ts", "n"], scd.is_delete("op", ["d"]), except_columns=["op"], track=track)
    return sorted(((r.k, r.a, r.b, r[scd.START], r[scd.END]) for r in got.collect()), key=str)


events = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 120), st.sampled_from("xyz"), st.sampled_from("pq"), st.booleans()), min_size=1, max_size=25
)
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(events)
def test_history_matches_brute_force(spark, evs):
    rows = log_rows(evs)
    assert spark_history(spark, rows) == sorted(brute_history(rows, ["a", "b"]), key=str)
    assert spark_history(spark, rows, ["a"]) == sorted(brute_history(rows, ["a"]), key=str)


@few
@given(events, st.randoms())
def test_order_of_arrival_and_replay_do_not_matter(spark, evs, rnd):
    rows = log_rows(evs)
    shuffled = rows + rows[: len(rows) // 2]
    rnd.shuffle(shuffled)
    assert spark_history(spark, shuffled) == spark_history(spark, rows)


@few
@given(events)
def test_type1_is_the_open_slice_of_type2(spark, evs):
    rows = log_rows(evs)
    log = spark.createDataFrame(rows, LOG_DDL)
    now = scd.cdc_scd1(log, ["k"], ["ts", "n"], scd.is_delete("op"), except_columns=["op"])
    open_rows = sorted((k, a, b) for k, a, b, _, e in spark_history(spark, rows) if e is None)
    assert sorted((r.k, r.a, r.b) for r in now.collect()) == open_rows


@few
@given(events)
def test_intervals_of_a_key_do_not_overlap(spark, evs):
    spans = {}
    for k, _, _, s, e in spark_history(spark, log_rows(evs)):
        spans.setdefault(k, []).append((s, e or datetime.max))
    for found in spans.values():
        found.sort()
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_tombstones_outlive_late_events(spark):
    def log(*rows):
        return spark.createDataFrame([(k, DAY0 + timedelta(hours=h), h, a, "-", op) for k, h, a, op in rows], LOG_DDL)

    gone = scd.is_delete("op")
    state = scd.cdc_scd1(log((1, 1, "x", "u"), (1, 5, "x", "d")), ["k"], ["ts"], gone, keep_tombstones=True)
    late = scd.cdc_scd1(log((1, 3, "y", "u"), (2, 2, "z", "u")), ["k"], ["ts"], gone, state=state)
    assert [(r.k, r.a) for r in late.collect()] == [(2, "z")]


def test_merge_history_splits_a_closed_interval(spark):
    first = log_rows([(1, 1, "x", "p", False), (1, 9, "z", "p", False), (2, 1, "x", "p", False)])
    late = [(1, DAY0 + timedelta(hours=4), 99, "y", "p", "u")]
    history = scd.cdc_scd2(spark.createDataFrame(first, LOG_DDL), ["k"], ["ts", "n"], scd.is_delete("op"), ["op"])
    log, touched = spark.createDataFrame(first + late, LOG_DDL), spark.createDataFrame(late, LOG_DDL)
    got = scd.merge_history(history, log, touched, ["k"], seq=["ts", "n"], delete_when=scd.is_delete("op"), except_columns=["op"])
    assert sorted(((r.k, r.a, r.b, r[scd.START], r[scd.END]) for r in got.collect()), key=str) == spark_history(spark, first + late)


def test_snapshot_history_twice_is_a_no_op(spark):
    v = lambda d: F.lit(d).cast("timestamp_ntz")
    ddl = "k int, a string, b string"
    one, two = spark.createDataFrame([(1, "x", "p"), (2, "y", None)], ddl), spark.createDataFrame([(2, "y", None), (3, "z", "q")], ddl)
    past = scd.apply_snapshot_scd2(scd.first_history(one, v("2024-01-01")), two, ["k"], v("2024-02-01"))
    again = scd.apply_snapshot_scd2(past, two, ["k"], v("2024-03-01"))
    assert sorted(map(str, past.collect())) == sorted(map(str, again.collect()))
    assert past.where("k = 1").head()[scd.END] == datetime(2024, 2, 1)
    assert past.where("k = 2").count() == 1  # NULL equals NULL


def test_untracked_columns_update_in_place(spark):
    v = lambda d: F.lit(d).cast("timestamp_ntz")
    ddl = "k int, a string, b string"
    past = scd.first_history(spark.createDataFrame([(1, "x", "p")], ddl), v("2024-01-01"))
    got = scd.apply_snapshot_scd2(past, spark.createDataFrame([(1, "x", "q")], ddl), ["k"], v("2024-02-01"), track=["a"]).collect()
    assert [(r.b, r[scd.START], r[scd.END]) for r in got] == [("q", datetime(2024, 1, 1), None)]


def test_duplicate_keys_in_a_snapshot(spark):
    snap = spark.createDataFrame([(1, "x"), (1, "y")], "k int, a string")
    prev = spark.createDataFrame([], "k int, a string")
    with pytest.raises(Exception, match="duplicate key in snapshot"):
        scd.apply_snapshot_scd1(prev, snap, ["k"]).collect()
    assert [r.a for r in scd.unique_by(snap, ["k"], "latest", ["a"]).collect()] == ["y"]


def test_no_key_passes_through(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x")], "k int, a string")
    assert scd.latest_per_key(df, [], ["a"]).count() == 2
    assert scd.cdc_scd1(df, [], ["a"]).count() == 2
    assert scd.apply_snapshot_scd1(df, df, []).count() == 2


def test_latest_per_key_thins_rows_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    plan = scd.latest_per_key(df, ["l_orderkey"], ["l_shipdate"])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle


def executed_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_shuffles_the_log_once(spark):
    log = spark.read.parquet("/root/testdata/sf0.01/events.parquet").withColumn("op", F.lit("u"))
    df = scd.cdc_scd2(log, ["user_id"], ["ts", "event_id"], scd.is_delete("op"), ["op"])
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    by_cell = [l for l in lines if "Exchange hashpartitioning(_cell" in l]
    by_key = [l for l in lines if "Exchange hashpartitioning(user_id" in l]
    # Two branches over one exchange (the second is reused at run time) and one small exchange.
    assert len(by_cell) == 2 and len(by_key) == 1 and "Join" not in "".join(lines)


def test_neighbours_do_not_shuffle_rows_again(spark):
    from laminae.operators.ordered import sessions as mark

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.read.parquet("/root/testdata/sf0.01/events.parquet").select("user_id", "ts", "event_id")
        df = mark(events, ["user_id"], "ts", "event_id", 1800, F.date_trunc("day", "ts"))
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Every exchange that carries event ids is the same one, by cell.
    assert "Exchange hashpartitioning(coalesce" not in plan
    assert plan.splitlines()[1].lstrip("+- :").startswith("Project")


def test_refreshed_sums_equal_recomputation(spark):
    ddl = "k int, g string, v int"
    old = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 3)], ddl)
    new = spark.createDataFrame([(1, "b", 1), (2, "a", 5), (4, "c", 4)], ddl)
    agg = lambda df: df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"))
    got = changes.refresh_sums(agg(old), changes.table_changes(old, new, ["k"]), ["g"], {"s": F.col("v")}, "n")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, agg(new).collect()))


# ---- ordered helpers on a hot key ---------------------------------------------------------------


@pytest.fixture(scope="module")
def hot(spark):
    """One key with most rows, over many days, with long silences and days without rows."""
    ts = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, int(id * id % 20011), 0)")
    return spark.range(3000).select(F.when(F.col("id") % 5 == 0, F.col("id") % 7).otherwise(99).alias("k"), ts.alias("ts"), "id", (F.col("id") % 17).cast("double").alias("v"))


def test_rolling_equals_plain_window(spark, hot):
    from pyspark.sql import Window as W

    w = W.partitionBy("k").orderBy("ts", "id").rowsBetween(-30, 0)
    plain = hot.withColumn("m", F.round(F.avg("v").over(w), 9))
    got = rolling(hot, ["k"], ["ts", "id"], F.date_trunc("day", "ts"), 30, {"m": F.avg("v")}, chunk_rows=50).withColumn("m", F.round("m", 9))
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()


def test_positions_and_sessions_equal_plain_window(spark, hot):
    from pyspark.sql import Window as W

    w = W.partitionBy("k").orderBy("ts", "id")
    pos = with_positions(hot, ["k"], ["ts", "id"], F.date_trunc("day", "ts"))
    plain = hot.withColumn("_position", F.row_number().over(w).cast("long"))
    assert pos.exceptAll(plain).isEmpty()
    gap = F.unix_seconds(F.col("ts").cast("timestamp")) - F.unix_seconds(F.lag("ts").over(w).cast("timestamp"))
    marked = hot.withColumn("s", F.when(gap.isNull() | (gap >= 600), 1).otherwise(0))
    plain = marked.withColumn("_session", F.sum("s").over(w)).drop("s")
    got = sessions(hot, ["k"], "ts", "id", 600, F.date_trunc("day", "ts"))
    assert got.exceptAll(plain).isEmpty() and got.count() == hot.count()


@pytest.fixture(scope="module")
def hot_day(spark):
    """A third of all rows in one day of one key; half of these, and some nulls, share one instant."""
    inside = F.expr("timestamp_ntz'2024-01-05' + make_dt_interval(0, 0, 0, if(id % 2 = 0, 5, id * 7 % 80000))")
    outside = F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, int(id * id % 20011), 0)")
    ts = F.when(F.col("id") % 3 == 0, inside).when(F.col("id") % 101 != 0, outside)
    rows = spark.range(12_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7 + 1).alias("k"), ts.alias("ts"), "id", (F.col("id") % 5).alias("v"))
    return rows.repartition(5, "id")


def test_crowded_cells_are_divided_by_the_data(spark, hot_day):
    limit = 240  # a fiftieth of all rows
    cells = celled(hot_day, ["k"], day_segment("ts"), ["ts", "id"], limit)
    sizes = cells.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ts", "id")).alias("lo"), F.max(F.struct("ts", "id")).alias("hi")).collect()
    assert max(r.n for r in sizes) <= limit and sum(r.n for r in sizes) == 12_000
    assert max(r["count"] for r in celled(hot_day, ["k"], day_segment("ts")).groupBy("_cell").count().collect()) == 4_000
    # cells of one key follow each other without overlap, in the order of their segments
    ordered_cells = cells.groupBy("_cell").agg(F.min(F.struct("ts", "id")).alias("lo"), F.max(F.struct("ts", "id")).alias("hi"))
    from pyspark.sql import Window as W

    after = ordered_cells.withColumn("next", F.lead("lo").over(W.partitionBy("_cell.k0").orderBy("_cell.seg")))
    assert after.where("next <= hi").isEmpty()
    # rows that are equal in every column that could divide them stay together
    same = hot_day.withColumn("id", F.lit(1))
    assert celled(same.where("k = 0"), ["k"], day_segment("ts"), ["ts", "id"], limit).groupBy("_cell").count().agg(F.max("count")).head()[0] == 2_000


def test_divided_cells_equal_plain_windows(spark, hot_day):
    from pyspark.sql import Window as W

    w = W.partitionBy("k").orderBy("ts", "id")
    args = (["k"], ["ts", "id"])
    same = lambda a, b: a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    pos = with_positions(hot_day, *args, day_segment("ts"), limit=100)
    assert same(pos, hot_day.withColumn("_position", F.row_number().over(w).cast("long")))
    near = with_neighbours(hot_day, *args, ["id"], day_segment("ts"), limit=100).select("k", "id", F.col("_prev.id").alias("p"), F.col("_next.id").alias("n"))
    assert same(near, hot_day.select("k", "id", F.lag("id").over(w).alias("p"), F.lead("id").over(w).alias("n")))
    rolled = rolling(hot_day, *args, day_segment("ts"), 9, {"m": F.sum("v")}, chunk_rows=50, limit=100)
    assert same(rolled, hot_day.withColumn("m", F.sum("v").over(w.rowsBetween(-9, 0))))
    log = hot_day.where("ts IS NOT NULL").withColumn("gone", F.col("id") % 11 == 0)
    versions_of = lambda limit: scd.cdc_scd2(log, ["k"], ["ts", "id"], F.col("gone"), ["gone"], track=["v"], segment=F.lit(1) if limit is None else None, limit=limit or 10**9)
    assert same(versions_of(100), versions_of(None))


def test_exact_percentiles_move_no_rows_for_few_groups(spark, run_dir):
    """Three groups hold all rows: a join that deals rows by group would sort a third of the table in one task."""
    df = spark.range(20_000).select(F.concat(F.lit("g"), F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 20011).cast("double").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = exact_percentiles(df, ["g"], "v", {"p50": 0.5})
        plan = made._jdf.queryExecution().executedPlan().toString()
        got = {r.g: r.p50 for r in made.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert got == {r.g: r.p for r in df.groupBy("g").agg(F.expr("percentile(v, 0.5)").alias("p")).collect()}


def test_exact_percentiles_with_outliers_ties_and_small_groups(spark):
    rows = [("big", float(i % 10)) for i in range(5000)] + [("big", 1e12)] + [("one", 4.0)] + [("two", 1.0), ("two", 2.0)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p999": 0.999, "p100": 1.0}
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs).collect()}
    want = df.groupBy("g").agg(*[F.expr(f"percentile(v, {p})").alias(n) for n, p in probs.items()]).where("g <> 'none'").collect()
    assert set(got) == {"big", "one", "two"}
    for r in want:
        assert all(got[r.g][n] == pytest.approx(r[n]) for n in probs), (r, got[r.g])
    whole = exact_percentiles(df, [], "v", {"p50": 0.5}).head()
    assert whole.p50 == pytest.approx(df.agg(F.expr("percentile(v, 0.5)").alias("p")).head().p)
