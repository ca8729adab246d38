"""Quality, conformance, drift, control, reconciliation, health, profile, metrics, security, vectors."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminae.operators import conform, control, drift, health, history, lineage, metrics, monitor, profile, quality, reconcile, security, vectors

SF = "/root/testdata/sf0.001"
NOW = datetime(2024, 2, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- quality -----------------------------------------------------------------------------------


@pytest.fixture
def measured(spark):
    return spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id int, q int")


def test_null_is_a_violation_but_not_quarantined(spark, measured):
    rule = quality.Rule("positive", "q > 0", "warn")
    m = quality.quality_metrics(measured, [rule], "t").head()
    assert (m.passed, m.failed) == (1, 2)
    assert [r.id for r in quality.expect_drop(measured, [quality.Rule("positive", "q > 0", "drop")]).collect()] == [1]
    held = quality.quarantine(measured, [rule, quality.Rule("small", "q < 3", "warn")], NOW).collect()
    assert sorted((r.id, r._quarantine_expectations, tuple(r._violated_expectations)) for r in held) == [
        (1, "positive,small", ("small",)),
        (2, "positive,small", ("positive",)),
    ]
    assert quality.quarantine(measured, [quality.Rule("x", "q > 0", "drop")]).count() == 0


def test_fail_is_not_optimised_away(measured):
    checked = quality.expect_fail(measured, [quality.Rule("positive", "q > 0", "fail")])
    with pytest.raises(Exception, match="expectation failed: positive"):
        checked.count()
    with pytest.raises(Exception, match="expectation failed: positive"):
        checked.select("id").collect()
    assert quality.expect_fail(measured, [quality.Rule("known", "id > 0", "fail")]).count() == 3
    with pytest.raises(ValueError):
        quality.Rule("x", "true", "explode")


def test_metrics_scan_once(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    rules = [quality.Rule(f"r{i}", f"l_quantity > {i}") for i in range(5)]
    text = plan(quality.quality_metrics(lines, rules, "lineitem"))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<l_quantity:double>" in text


# ---- conformance and drift ---------------------------------------------------------------------


def test_steps_in_order(spark):
    df = spark.createDataFrame([(" a ", "N/A", "7x"), ("b", "", "8")], "s string, t string, n string")
    steps = [
        {"type": "trim_strings", "columns": ["s"]},
        {"type": "null_standardize"},
        {"type": "cast", "column": "n", "target_type": "int", "safe": True},
        {"type": "rename_column", "from": "s", "to": "name"},
        {"type": "add_column", "name": "up", "expression": "upper(name)"},
        {"type": "drop_columns", "columns": ["t"]},
    ]
    got = conform.conform(df, steps, NOW).select("name", "n", "up", "_is_current").collect()
    assert [tuple(r) for r in got] == [("a", None, "A", True), ("b", 8, "B", True)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform.conform(df, [{"type": "cast", "column": "n", "target_type": "int"}]).collect()
    with pytest.raises(ValueError, match="unknown transformation"):
        conform.conform(df, [{"type": "shuffle"}])


def test_steps_run_in_one_stage_of_generated_code(spark):
    df = spark.read.parquet(f"{SF}/customer.parquet")
    got = conform.conform(df, [{"type": "trim_strings"}, {"type": "null_standardize"}], NOW)
    text = got._jdf.queryExecution().explainString(got._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert text.count("Scan parquet") >= 1 and "Exchange" not in text and "Python" not in text


def test_drift():
    ddl = lambda s: T._parse_datatype_string(s)
    old, new = ddl("a int, b string, s struct<x:int,y:int>"), ddl("a bigint, c string, s struct<x:int,z:int>, _load_type string")
    d = drift.detect(new, old)
    assert (d.added, d.dropped, d.retyped) == (["c", "s.z"], ["b", "s.y"], ["a: int -> bigint"])
    assert not drift.detect(new, None) and not drift.detect(old, old)
    with pytest.raises(drift.SchemaDriftError, match="drop_column not allowed"):
        drift.enforce(d, ["add_column", "type_change"])
    drift.enforce(d, drift.CHANGE_KINDS)


def test_drift_check_and_evolution(spark):
    old, new = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2**40, 1.5)], "a bigint, c double")
    with pytest.raises(drift.SchemaDriftError):
        drift.check(new, old, "strict")
    found = drift.check(new, old)
    row = drift.drift_record(spark, "t", new.schema, found, "2024-02-01 00:00:00").head()
    assert len(row.schema_hash) == 64 and "add_column" in row.changes
    got = drift.evolve_union(old, new)
    assert got.dtypes == [("a", "bigint"), ("b", "string"), ("c", "double")] and got.count() == 2


def test_nested_types_are_merged_by_name(spark):
    frame = lambda ddl, sql: spark.sql(f"SELECT {sql}").select(F.from_json("j", ddl).alias("x")).select("x.*")
    old = frame("k int, s struct<a:int,b:string>, l array<struct<a:int>>, m map<string,struct<v:int>>, n struct<i:struct<p:int>>", """'{"k":1,"s":{"a":1,"b":"x"},"l":[{"a":1},null],"m":{"q":{"v":1}},"n":null}' AS j""")
    new = frame("k bigint, s struct<c:double,a:bigint>, l array<struct<b:string,a:bigint>>, m map<string,struct<v:bigint,w:string>>, n struct<i:struct<q:string>>", """'{"k":2,"s":{"c":0.5,"a":7},"l":[{"a":2,"b":"y"}],"m":{"q":{"v":2,"w":"z"}},"n":{"i":{"q":"deep"}}}' AS j""")
    got = drift.evolve_union(old, new)
    assert got.schema.simpleString() == "struct<k:bigint,s:struct<a:bigint,b:string,c:double>,l:array<struct<a:bigint,b:string>>,m:map<string,struct<v:bigint,w:string>>,n:struct<i:struct<p:int,q:string>>>"
    a, b = (r.asDict(recursive=True) for r in got.orderBy("k").collect())
    assert a == {"k": 1, "s": {"a": 1, "b": "x", "c": None}, "l": [{"a": 1, "b": None}, None], "m": {"q": {"v": 1, "w": None}}, "n": None}
    assert b == {"k": 2, "s": {"a": 7, "b": None, "c": 0.5}, "l": [{"a": 2, "b": "y"}], "m": {"q": {"v": 2, "w": "z"}}, "n": {"i": {"p": None, "q": "deep"}}}
    # merged again, nothing changes
    assert drift.evolve_union(got, old).schema.simpleString() == got.schema.simpleString()
    found = drift.detect(new.schema, old.schema)
    assert found.added == ["l[].b", "m{}.w", "n.i.q", "s.c"] and found.dropped == ["n.i.p", "s.b"]
    assert found.retyped == ["k: int -> bigint", "l[].a: int -> bigint", "m{}.v: int -> bigint", "s.a: int -> bigint"]


@pytest.mark.parametrize(("a", "b"), [("struct<a:int>", "string"), ("array<int>", "int"), ("map<string,int>", "struct<a:int>"), ("struct<a:struct<b:int>>", "struct<a:int>")])
def test_types_that_cannot_be_widened_are_refused(spark, a, b):
    one, two = (spark.createDataFrame([], f"k int, v {t}") for t in (a, b))
    with pytest.raises(drift.SchemaDriftError, match="^v"):
        drift.evolve_union(one, two)


# ---- control, reconciliation, health -----------------------------------------------------------


def test_watermarks_advance(spark, run_dir):
    ctl = control.Control(spark, f"{run_dir}/control")
    ddl = "id int, ts timestamp_ntz"
    day = lambda d: datetime(2024, 1, d)
    first = spark.createDataFrame([(1, day(1)), (2, day(2))], ddl)
    second = first.union(spark.createDataFrame([(3, day(3))], ddl))
    load = lambda df, at: control.incremental_load(ctl, "t", df, "ts", f"{run_dir}/raw", at)
    assert load(first, datetime(2024, 2, 1)) == 2
    assert load(first, datetime(2024, 2, 2)) == 0
    assert load(second, datetime(2024, 2, 3)) == 1
    assert ctl.watermark("t") == "2024-01-03 00:00:00" and ctl.watermark("other") is None
    assert sorted(r.id for r in spark.read.parquet(f"{run_dir}/raw").collect()) == [1, 2, 3]


def test_batch_versions(spark, run_dir):
    ctl = control.Control(spark, f"{run_dir}/control")
    assert [ctl.next_batch("t", NOW) for _ in range(3)] == [1, 2, 3] and ctl.next_batch("u", NOW) == 1


def test_reconciliation(spark):
    ddl = "k int, v string"
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (5, "e")], ddl)
    state = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "d")], ddl)
    want = [(2, "changed"), (4, "extra"), (5, "missing")]
    for compare in (reconcile.full_compare, reconcile.key_hash):
        assert sorted(map(tuple, compare(source, state, ["k"]).collect())) == want
    row = reconcile.log_rows(reconcile.full_compare(source, state, ["k"]), "t", "full_snapshot", NOW).head()
    assert (row.status, row.details) == ("mismatch", "missing=1 extra=1 changed=1")
    assert reconcile.log_rows(reconcile.key_hash(state, state, ["k"]), "t", "key_hash", NOW).head().status == "match"


def test_alert_states(spark):
    value = lambda v: spark.createDataFrame([(v,)], "v double")
    state = lambda v, op, t: health.alert(value(v), "a", op, t).head().state
    assert [state(5.0, op, 5) for op in health.COMPARISONS] == ["TRIGGERED", "OK", "OK", "TRIGGERED", "OK", "TRIGGERED"]
    assert state(None, "EQUAL", 1) == "UNKNOWN"
    assert health.alert(value(1.0), "a", "EQUAL", 2, notify_on_ok=True).head().notify
    with pytest.raises(ValueError):
        health.alert(value(1.0), "a", "NEAR", 2)


# ---- history -----------------------------------------------------------------------------------


def test_as_of_join_bounds(spark):
    t = lambda h: datetime(2024, 1, 31, h)
    hist = spark.createDataFrame([(1, "a", t(0), t(12)), (1, "b", t(12), None), (2, "z", t(3), t(4))], "k int, v string, __START_AT timestamp_ntz, __END_AT timestamp_ntz")
    facts = spark.createDataFrame([(10, 1, t(0)), (11, 1, t(12)), (12, 1, datetime(2025, 6, 1)), (13, 2, t(4)), (14, 3, t(1))], "f int, k int, at timestamp_ntz")
    got = history.join_as_of(facts, hist, ["k"], "at", ["v"])
    assert sorted((r.f, r.v) for r in got.collect()) == [(10, "a"), (11, "b"), (12, "b")]
    left = history.join_as_of(facts, hist, ["k"], "at", ["v"], how="left")
    assert left.count() == 5


@pytest.mark.parametrize("limit", [None, 50])
def test_sweep_equals_the_range_join(spark, limit):
    """Keys that are null, hot, without versions or without facts; gaps, equal times, nulls in time."""
    at = lambda c: F.expr(f"timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, int({c}), 0)")
    k = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 17 != 0, F.col("id") % 9)
    facts = spark.range(1500).select("id", k.alias("k"), F.when(F.col("id") % 40 != 0, at("id * id % 997")).alias("at")).unionAll(
        spark.range(300).select(F.col("id") + 5000, F.lit(0), at("500"))
    )
    starts = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).alias("k")).where("k IS NULL OR k <> 5").crossJoin(spark.range(60).withColumnRenamed("id", "n"))
    hist = starts.select("k", "n", at("n * 17").alias("__START_AT"), F.when(F.col("n") < 59, at("n * 17 + 17 - if(n % 4 = 0, 9, 0)")).alias("__END_AT"))
    hist = hist.unionAll(spark.createDataFrame([(77, 1, datetime(2024, 1, 1), None)], hist.schema))
    on = F.expr("f.k <=> h.k AND f.at >= h.__START_AT AND (f.at < h.__END_AT OR h.__END_AT IS NULL)")
    for how in ("inner", "left"):
        got = history.join_as_of(facts, hist, ["k"], "at", ["n"], how=how, limit=limit)
        want = facts.alias("f").join(hist.alias("h"), on, how).select("f.*", "h.n")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 1000


def test_short_history_goes_to_the_facts(spark, monkeypatch):
    """Few keys hold all facts: none moves. A history that is not short is joined by the sweep, with the same rows."""
    at = lambda c: F.expr(f"timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, int({c}), 0)")
    k = F.when(F.col("id") % 3 != 0, F.col("id") % 4)
    facts = spark.range(3000).select("id", k.alias("k"), F.when(F.col("id") % 40 != 0, at("id * id % 997")).alias("at"))
    hist = spark.range(160).select(F.when(F.col("id") % 4 < 3, F.col("id") % 4).alias("k"), F.col("id").alias("n"), at("floor(id / 4) * 25").alias("__START_AT"))
    hist = hist.withColumn("__END_AT", F.expr("__START_AT + make_dt_interval(0, 0, if(n % 7 = 0, 9, 25), 0)"))
    on = F.expr("f.k <=> h.k AND f.at >= h.__START_AT AND (f.at < h.__END_AT OR h.__END_AT IS NULL)")
    for how in ("inner", "left"):
        want = facts.alias("f").join(hist.alias("h"), on, how).select("f.*", "h.n")
        for most in (256, 5):
            monkeypatch.setattr(history, "MOST", most)
            got = history.join_as_of(facts, hist, ["k"], "at", ["n"], how=how, short=True)
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert ("Exchange hashpartitioning" not in plan) == (most == 256)
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 1000


def test_sweep_shuffles_each_row_once(spark):
    facts = spark.range(100).select(F.col("id").alias("k"), F.expr("timestamp_ntz'2024-01-01'").alias("at"))
    hist = facts.select("k", F.col("at").alias("__START_AT"), F.lit(None).cast("timestamp_ntz").alias("__END_AT"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = history.join_as_of(facts, hist, ["k"], "at", ["v"])._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = plan[plan.index("== Physical Plan") :]
    # rows by cell once; the cells' newest versions by key and back
    assert physical.count("Exchange hashpartitioning") <= 4 and "Generate" not in physical and "BroadcastNestedLoop" not in physical


# ---- profile and monitors ----------------------------------------------------------------------


@pytest.fixture
def lines(spark):
    """Order lines with a column of each kind that a profile tells apart."""
    n = F.col("id") + 1
    return spark.range(5).select(
        n.alias("line_id"),
        F.concat(F.lit("clerk "), n.cast("string")).alias("l_clerk"),
        F.when(n % 2 == 1, "R").otherwise("A").alias("l_returnflag"),
        (n * 0.02).alias("l_discount"),
        (n * 7).cast("int").alias("l_quantity"),
        n.cast("float").alias("l_weight"),
        F.array(F.lit("AIR")).alias("l_shipmodes"),
        F.expr("timestamp'1995-03-01' + make_dt_interval(int(id))").alias("l_shipdate"),
        (n > 3).alias("l_open"),
    )


def test_profile_types_and_fields(lines):
    got = {r.column_name: r for r in profile.profile(lines).collect()}
    kinds = {n: r.data_type for n, r in got.items()}
    numeric = ["l_discount", "l_quantity", "l_weight"]
    assert kinds == {"line_id": "id", "l_clerk": "categorical", "l_returnflag": "categorical", **dict.fromkeys(numeric, "numeric"), "l_shipmodes": "array", "l_shipdate": "timestamp", "l_open": "boolean"}
    assert (got["l_quantity"].min_value, got["l_quantity"].max_value, got["l_quantity"].median) == ("7", "35", 21)
    assert got["l_shipmodes"].unique_count is None and got["l_shipmodes"].total_count == 5
    assert got["l_shipdate"].histogram and got["l_clerk"].min_value is None
    light = profile.at_level(profile.profile(lines), "SIMPLE").columns
    assert "histogram" not in light and "stddev_value" not in light and "q1" not in light
    assert profile.at_level(profile.profile(lines), "NONE").columns == ["column_name", "data_type"]


def test_profile_is_one_scan(spark):
    text = plan(profile.profile(spark.read.parquet(f"{SF}/lineitem.parquet")))
    assert text.count("FileScan") == 1


def test_many_distinct_values_become_string(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("txt"), F.lit("x").alias("_hidden"))
    row = profile.profile(df).collect()
    assert [(r.column_name, r.data_type) for r in row] == [("txt", "string")]


def test_value_counts_and_samples(lines):
    assert set(profile.countable_columns(lines)) == {"l_clerk", "l_returnflag", "l_open"}
    got = {(r.column_name, r.value): r["count"] for r in profile.value_counts(lines, ["l_returnflag", "l_open"]).collect()}
    assert got[("l_returnflag", "R")] == 3 and got[("l_open", "true")] == 2
    samples = profile.sample_values(lines.withColumn("l_clerk", F.lit("a clerk with a long name")))
    assert samples["l_clerk"] == ["a clerk with a ..."] and len(samples["l_discount"]) == 3


def test_table_patterns_and_cache(spark, run_dir):
    assert profile.match_tables(["orders", "order_x", "part"], ["ord*", "gone"]) == ["gone", "order_x", "orders"]
    cache = profile.ProfileCache(spark, f"{run_dir}/cache")
    spark.range(5).write.parquet(f"{run_dir}/t")
    a = cache.get("t", f"{run_dir}/t").inputFiles()
    assert cache.get("t", f"{run_dir}/t").inputFiles() == a
    spark.range(5).write.mode("append").parquet(f"{run_dir}/t")
    assert cache.get("t", f"{run_dir}/t").inputFiles() != a


def test_profile_folders(spark, run_dir):
    got = profile.profile_files(spark, f"{SF}/supplier.parquet").collect()
    assert len(got) == 4 and got[0].file_count == 1 and got[0].error is None
    assert profile.profile_files(spark, f"{run_dir}/none").head().error.startswith("cannot read path")
    import os

    os.makedirs(f"{run_dir}/empty")
    assert "error" in profile.profile_files(spark, f"{run_dir}/empty").columns


def test_refresh_history(spark):
    one = monitor.snapshot(spark.createDataFrame([(1.0,), (None,)], "v double"), "t", 1)
    two = monitor.snapshot(spark.createDataFrame([(1.0,), (3.0,)], "v double"), "t", 2)
    row = monitor.refresh_history(one.unionByName(two)).where("refresh_id = 2").head()
    assert (row.null_rate_change, row.mean_change, row.unique_change, row.row_change) == (-0.5, 1.0, 1, 0)


# ---- metric views, security, lineage -----------------------------------------------------------


def test_metric_views(spark):
    orders = spark.createDataFrame([(1, 1, 10.0, "a"), (2, 1, 5.0, "b"), (3, 2, 1.0, "a")], "id int, cust int, amount double, status string")
    cust = spark.createDataFrame([(1, "x")], "cust int, name string")
    view = metrics.MetricView(
        orders,
        {"status": "status", "who": "c.name", "big": "amount > 4"},
        {"total": "sum(amount)", "avg": "avg(amount)"},
        joins=[metrics.Join("c", cust, using=["cust"])],
        combine={"total": "sum"},
    )
    got = metrics.query(view, ["total"], ["who"], order_by="ALL").collect()
    assert [tuple(r) for r in got] == [(None, 1.0), ("x", 15.0)]
    assert metrics.query(view, ["total", "avg"]).head().total == 16.0
    assert metrics.query(view, ["total"], ["status"], where="big", limit=1, order_by="status").collect() == metrics.query(view, ["total"], ["status"], where="big").where("status = 'a'").collect()
    stored = metrics.materialize(view, ["who", "status"], ["total", "avg"])
    assert "FileScan" not in plan(metrics.query_materialized(view, stored, ["total"], ["who"]))
    assert metrics.query_materialized(view, stored, ["total"]).head().total == 16.0
    assert metrics.query_materialized(view, stored, ["avg"]).head().avg == pytest.approx(16 / 3)  # goes to the source
    with pytest.raises(ValueError):
        metrics.query(view, ["nothing"])
    with pytest.raises(ValueError):
        metrics.MetricView(orders, {}, {"n": "count(*)"})
    with pytest.raises(ValueError):
        metrics.MetricView(orders, {"amount": "round(amount)"}, {"n": "count(*)"})
    with pytest.raises(ValueError):
        metrics.Join("c", cust)


def test_row_filter_and_mask(spark):
    people = spark.createDataFrame([(i, f"e{i}@x.com", "Engineering" if i < 3 else "Sales", 10.0 * i) for i in range(5)], "id bigint, email string, department string, salary double")
    view = security.SecuredView(people).set_row_filter(F.col("department") == "Engineering").set_mask("department", F.lit("hidden")).set_mask("email", F.lit("***"))
    assert [tuple(r) for r in view.read().select("email", "department").distinct().collect()] == [("***", "hidden")]
    assert view.read().count() == 3
    assert view.drop_row_filter().drop_mask("email").read().select("email").distinct().count() == 5
    security.create_function(spark, "lam_is_low", "x DOUBLE", "BOOLEAN", "x < 25")
    assert people.where(security.call("lam_is_low", ["salary"])).count() == 3
    for bad in ("a b", "1x", "x;drop"):
        with pytest.raises(ValueError):
            security.checked_identifier(bad)
    with pytest.raises(ValueError):
        view.set_mask("none", F.lit(1))


def test_closure_with_a_cycle_stops(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "b")], "s string, t string")
    got = lineage.closure(edges, "c", "s", "t", max_depth=4)
    assert sorted((r.s, r.t, r.depth) for r in got.collect()) == [("a", "b", 2), ("b", "c", 1), ("b", "c", 4), ("c", "a", 3), ("x", "b", 2)]


# ---- vectors -----------------------------------------------------------------------------------


@pytest.fixture
def index(spark):
    return spark.createDataFrame([(i, f"t{i}", [float(i == j) + 0.1 * ((i + j) % 2) for j in range(8)]) for i in range(1, 6)], "id int, text string, embedding array<float>")


def test_vector_search(index):
    own = index.where("id = 1").head().embedding
    got = vectors.topk(index, "embedding", own, "id", 3, ["id", "text"]).collect()
    assert got[0].id == 1 and got[0].score == pytest.approx(1.0) and len(got) == 3
    assert vectors.topk(index, "embedding", own, "id", 1, filters={"id": [2, 3]}).head().id in (2, 3)
    assert vectors.topk(index, "embedding", own, "id", 9, filters="id > 3").count() == 2
    with pytest.raises(ValueError):
        vectors.topk(index, "embedding", None, "id")
    left = vectors.delete(index, index.where("id in (4, 5)"), ["id"])
    assert vectors.scan(left).count() == 3
    fresh = index.where("id = 1").withColumn("text", F.lit("new"))
    assert vectors.upsert(index, fresh, ["id"]).where("id = 1").head().text == "new"
    assert vectors.sync(index, left, ["id"], ["text"]).count() == 3


def test_ann_recall(spark):
    base = spark.read.parquet(f"{SF}/embeddings.parquet")
    hits = total = 0
    for row in base.orderBy("vec_id").limit(3).collect():
        near = {r.vec_id for r in vectors.topk(base, "embedding", row.embedding, "vec_id", 10).collect()}
        got = {r.vec_id for r in vectors.ann(base, "embedding", row.embedding, "vec_id", 10).collect()}
        hits, total = hits + len(near & got), total + len(near)
    assert hits / total >= 0.9


def test_bm25_counts_whole_words(spark):
    docs = spark.createDataFrame([(1, "The the, THE!"), (2, "other things; then"), (3, "the end"), (4, "")], "id int, text string")
    got = {r.id: r.keyword_score for r in vectors.bm25(docs, "id", "text", ["the"]).collect()}
    assert set(got) == {1, 3} and got[1] > got[3]


def test_decimals_widen_without_losing_digits():
    from pyspark.sql import types as T

    from laminae.operators.drift import _common_type

    assert _common_type(T.DecimalType(12, 2), T.DecimalType(18, 4)) == "decimal(18,4)"
    assert _common_type(T.DecimalType(12, 2), T.IntegerType()) == "decimal(12,2)"
    assert _common_type(T.LongType(), T.DecimalType(12, 2)) == "decimal(21,2)"
    assert _common_type(T.DecimalType(12, 2), T.DoubleType()) == "double"
    with pytest.raises(ValueError):
        _common_type(T.DecimalType(38, 0), T.DecimalType(38, 10))


def test_ann_returns_k_rows_and_hybrid_ranks_all(spark):
    import numpy as np

    from laminae.operators import vectors

    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)]
    table = spark.createDataFrame(rows, "id long, v array<double>")
    assert vectors.ann(table, "v", rows[0][1], "id", 300).count() == 300
    docs = spark.createDataFrame([(i, "the " * (i % 7 + 1) + f"x{i}") for i in range(300)], "id long, text string")
    keywords = vectors.bm25(docs, "id", "text", ["the"]).collect()
    place = {r.id: n for n, r in enumerate(sorted(keywords, key=lambda r: (-r.keyword_score, r.id)), 1)}
    q = np.array(rows[0][1])
    cos = {i: float(np.dot(q, v) / np.linalg.norm(q) / np.linalg.norm(v)) for i, v in rows}
    near = {i: n for n, i in enumerate(sorted(cos, key=lambda i: (-cos[i], i)), 1)}
    want = {i: 1 / (vectors.RRF_CONSTANT + near[i]) + 1 / (vectors.RRF_CONSTANT + place[i]) for i in near}
    got = {r.id: r.score for r in vectors.hybrid(table, "v", rows[0][1], docs, "text", ["the"], "id", 300).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in got)
