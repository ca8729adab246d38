"""Contracts, gold models and the layered run."""

import warnings
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from laminae import config
from laminae.operators import scd
from laminae.operators.drift import SchemaDriftError
from laminae.plans import gold, medallion
from laminae.sinks import versions

SF = "/root/testdata/sf0.001"
T0 = datetime(2024, 1, 1)


def raw(name="t", key=("k",), **load):
    return {
        "target_name": name, "source": "s", "source_schema": "x", "source_table": name,
        "load": {"strategy": "snapshot", "primary_key": list(key), **load},
    }


# ---- contracts ---------------------------------------------------------------------------------


def test_packaged_contracts():
    got = config.load_contracts()
    assert [c.target_name for c in got] == ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    line = got[-1]
    assert line.primary_key == line.merge_keys == ("l_orderkey", "l_linenumber") and line.on_duplicate == "latest"
    assert [r.action for r in line.rules] == ["fail", "warn"] and not line.streaming


def test_strategies_and_legacy_types():
    s = config.strategy_of
    assert s({}) == "snapshot" and s({"type": "incremental"}) == "incremental" and s({"type": "stream"}) == "stream"
    assert s({"type": "stream", "stream": {"source_type": "cdc"}}) == "cdc" and s({"strategy": "CDC"}) == "cdc"
    for bad in ({"strategy": "magic"}, {"type": "magic"}):
        with pytest.raises(config.ContractError):
            s(bad)


def test_defaults_and_stream_settings():
    env = config.Environment("prod", "/ck", None, "10 seconds")
    c = config.table_contract(raw(strategy="cdc", watermark_column="w"), env)
    assert c.sequence_by_column == "w" and c.delete_values == ("d", "delete", "DELETE") and c.operation_column == "op"
    assert c.stream.checkpoint_location == "/ck/bronze/t" and c.stream.trigger_interval == "10 seconds" and c.stream.source_type == "cdc"
    assert c.streaming and c.audit["retention_days"] == 90 and c.reconciliation["method"] == "full_snapshot"
    plain = config.table_contract(raw(strategy="stream", stream={"trigger_interval": "5 seconds", "max_offsets_per_trigger": 9}))
    assert plain.stream.trigger_interval == "5 seconds" and plain.stream.max_offsets_per_trigger == 9


def test_environment_action_is_announced():
    doc = raw() | {"quality": {"expectations": [{"name": "a", "constraint": "k > 0", "action": "warn"}]}}
    env = config.load_environment("prod")
    with pytest.warns(UserWarning, match=r"prod sets fail for \['a'\]"):
        assert config.table_contract(doc, env).rules[0].action == "fail"
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert config.table_contract(doc, config.load_environment("dev")).rules[0].action == "warn"


def test_folder_of_contracts(tmp_path):
    import yaml

    (tmp_path / "b").mkdir()
    for place, doc in (("b/two.yml", raw("two") | {"execution_order": 5}), ("one.yml", raw("one") | {"execution_order": 5}), ("_skip.yml", raw("no")), ("off.yml", raw("off") | {"enabled": False})):
        (tmp_path / place).write_text(yaml.safe_dump({"table": doc}))
    assert [c.target_name for c in config.load_contracts(tmp_path)] == ["two", "one"]


# ---- gold --------------------------------------------------------------------------------------


def test_model_order_and_cycles():
    m = lambda n, *d: gold.Model(n, lambda s: None, depends_on=d)
    assert [x.name for x in gold.in_order([m("c", "b"), m("b", "a", "elsewhere"), m("a")])] == ["a", "b", "c"]
    with pytest.raises(ValueError, match="circle"):
        gold.in_order([m("a", "b"), m("b", "a")])


def test_date_dimension(spark):
    d = gold.dim_date(spark)
    assert d.count() == 7670
    row = d.where("date_key = DATE'2024-02-29'").head()
    assert (row.quarter_name, row.year_quarter, row.year_month, row.day_name, row.day_of_week, row.is_weekend) == ("Q1", "2024-Q1", "2024-02", "Thursday", 5, False)


def test_history_model_without_key_is_rebuilt(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    keyless = gold.Model("m", lambda s: df, scd_type=2)
    assert gold.refresh(keyless, {}, None, F.lit(T0)).columns == ["k", "v"]
    kept = gold.Model("m", lambda s: df, 2, ("k",))
    assert scd.END in gold.refresh(kept, {}, None, F.lit(T0)).columns


def test_sql_models(spark, tmp_path):
    (tmp_path / "m.yml").write_text("gold_model: {name: big, source_tables: [silver.nation], sql: 'SELECT n_name FROM nation WHERE n_nationkey > 20'}")
    model = gold.load_sql_models(str(tmp_path), spark)[0]
    assert model.build({"nation": spark.read.parquet(f"{SF}/nation.parquet")}).count() == 4


# ---- the run -----------------------------------------------------------------------------------


def reader(frames):
    from laminae.sources.tables import above_watermark

    def read(contract, last):
        df = frames[contract.target_name]
        return above_watermark(df, contract.watermark_column, last) if contract.strategy == "incremental" else df

    return read


def test_whole_star_and_second_run_changes_nothing(spark, run_dir):
    contracts = config.load_contracts()
    frames = {c.target_name: spark.read.parquet(f"{SF}/{c.source_table}.parquet") for c in contracts}
    first = medallion.medallion_run(spark, run_dir, contracts, reader(frames), T0)
    assert all(s.changed for s in first) and {s.layer for s in first} == {"bronze", "silver", "quarantine", "gold"}
    fact = versions.read_version(spark, f"{run_dir}/gold/fact_order_line")
    lines = frames["lineitem"].select("l_orderkey", "l_linenumber").distinct().count()
    assert fact.count() == lines
    dim = versions.read_version(spark, f"{run_dir}/gold/dim_customer")
    assert dim.count() == 150 and dim.where(F.col(scd.END).isNull()).count() == 150
    assert spark.read.parquet(f"{run_dir}/control/quality_metrics").where("table_name = 'lineitem'").count() == 2

    again = medallion.medallion_run(spark, run_dir, contracts, reader(frames), T0 + timedelta(days=1))
    assert not any(s.changed for s in again)

    frames["customer"] = frames["customer"].withColumn("c_acctbal", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    third = medallion.medallion_run(spark, run_dir, contracts, reader(frames), T0 + timedelta(days=2))
    assert {(s.layer, s.table) for s in third if s.changed} == {("bronze", "customer"), ("silver", "customer"), ("gold", "dim_customer")}
    dim = versions.read_version(spark, f"{run_dir}/gold/dim_customer")
    moved = frames["customer"].where("c_mktsegment = 'BUILDING'").count()
    assert dim.count() == 150 + moved and dim.where(F.col(scd.END).isNull()).count() == 150


def one_table(spark, run_dir, doc):
    c = config.table_contract(doc)

    def go(df, day, layer="silver"):
        steps = medallion.medallion_run(spark, run_dir, [c], reader({"t": df}), T0 + timedelta(days=day), models=[])
        return versions.read_version(spark, f"{run_dir}/{layer}/t"), steps

    return go


def test_incremental_keeps_older_state(spark, run_dir):
    go = one_table(spark, run_dir, raw(strategy="incremental", watermark_column="n"))
    ddl = "k int, n int, v string"
    go(spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], ddl), 0)
    source = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (2, 3, "B"), (3, 4, "c")], ddl)
    got, _ = go(source, 1)
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (2, "B"), (3, "c")]
    _, steps = go(source, 2)
    assert not any(s.changed for s in steps)


def test_snapshot_history_through_the_layers(spark, run_dir):
    go = one_table(spark, run_dir, raw(stored_as_scd_type=2, snapshot_audit={"enabled": True}))
    ddl = "k int, v string"
    go(spark.createDataFrame([(1, "a"), (2, "b")], ddl), 0)
    got, _ = go(spark.createDataFrame([(1, "A")], ddl), 1)
    rows = sorted((r.k, r.v, r[scd.END] is None, r._is_current) for r in got.collect())
    assert rows == [(1, "A", True, True), (1, "a", False, False), (2, "b", False, False)]
    assert spark.read.parquet(f"{run_dir}/audit/t").select("_batch_id").distinct().count() == 2


def test_silver_history(spark, run_dir):
    go = one_table(spark, run_dir, raw() | {"silver": {"scd_type": 2}})
    go(spark.createDataFrame([(1, "a")], "k int, v string"), 0)
    got, _ = go(spark.createDataFrame([(1, "b")], "k int, v string"), 1)
    assert sorted((r.v, r[scd.END] is None, r._is_current) for r in got.collect()) == [("a", False, False), ("b", True, True)]


def test_change_log_with_deletes(spark, run_dir):
    go = one_table(spark, run_dir, raw(strategy="cdc", sequence_by_column="n"))
    ddl = "k int, n int, v string, op string"
    go(spark.createDataFrame([(1, 1, "a", "c"), (2, 5, "b", "D")], ddl), 0)
    got, _ = go(spark.createDataFrame([(2, 3, "late", "u"), (3, 1, "x", "u")], ddl), 1)
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, "a"), (3, "x")]


def test_history_of_a_change_log_from_new_events_only(spark, run_dir):
    go = one_table(spark, run_dir, raw(strategy="cdc", sequence_by_column="n", stored_as_scd_type=2))
    ddl = "k int, n timestamp, v string, op string"
    day = lambda d: datetime(2024, 1, d)
    first = [(1, day(1), "a", "c"), (1, day(3), "b", "u"), (2, day(2), "x", "c")]
    later = [(1, day(2), "late", "u"), (3, day(4), "new", "c"), (1, day(3), "b", "u")]
    go(spark.createDataFrame(first, ddl), 0, "bronze")
    got, _ = go(spark.createDataFrame(later, ddl), 1, "bronze")
    versions_of = lambda df: sorted((r.k, r.v, r[scd.START], r[scd.END] or datetime.max) for r in df.collect())
    whole = scd.cdc_scd2(spark.createDataFrame(first + later, ddl), ["k"], ["n"], scd.is_delete("op"), ["op"])
    assert versions_of(got) == versions_of(whole) and len(versions_of(got)) == 5
    assert sum(spark.read.parquet(f"{run_dir}/raw/t").groupBy("_batch_id").count().toPandas()["count"]) == 6


def test_change_log_takes_a_new_column(spark, run_dir):
    go = one_table(spark, run_dir, raw(strategy="cdc", sequence_by_column="n"))
    go(spark.createDataFrame([(1, 1, "a", "c")], "k int, n int, v string, op string"), 0)
    got, _ = go(spark.createDataFrame([(2, 2, "b", "c", 1.5)], "k int, n int, v string, op string, w double"), 1)
    assert sorted((r.k, r.v, r.w) for r in got.collect()) == [(1, "a", None), (2, "b", 1.5)]


def test_schema_change_is_absorbed_or_refused(spark, run_dir):
    go = one_table(spark, run_dir, raw())
    go(spark.createDataFrame([(1, "a")], "k int, v string"), 0)
    got, _ = go(spark.createDataFrame([(1, "a", 2.0)], "k int, v string, w double"), 1)
    assert got.head().w == 2.0 and spark.read.parquet(f"{run_dir}/control/schema_drift").count() == 1
    strict = one_table(spark, run_dir, raw() | {"schema_drift": {"mode": "strict", "allowed_changes": []}})
    with pytest.raises(SchemaDriftError):
        strict(spark.createDataFrame([(1, 5)], "k int, v int"), 2)


@pytest.mark.parametrize("load", [{}, {"strategy": "cdc", "sequence_by_column": "n"}])
def test_own_columns_are_no_drift(spark, run_dir, load):
    """Audit columns of the state and the operation of a change log: a strict contract goes on."""
    doc = raw(**load) | {"schema_drift": {"mode": "strict", "allowed_changes": []}}
    go = one_table(spark, run_dir, doc)
    for n in (1, 2):
        got, _ = go(spark.createDataFrame([(1, n, "c")], "k int, n int, op string"), n, "bronze")
    assert [r.n for r in got.collect()] == [2]
    assert versions.committed(spark, f"{run_dir}/control", "schema_drift") == []
    seen = spark.read.parquet(f"{run_dir}/control/source_metadata")
    assert seen.count() == 1 and seen.head().table_name == "t"


def test_failing_rule_stops_the_run_and_keeps_the_old_version(spark, run_dir):
    doc = raw() | {"quality": {"expectations": [{"name": "ok", "constraint": "k > 0", "action": "fail"}]}}
    go = one_table(spark, run_dir, doc)
    go(spark.createDataFrame([(1, "a")], "k int, v string"), 0)
    with pytest.raises(Exception, match="expectation failed: ok"):
        go(spark.createDataFrame([(1, "a"), (-1, "b")], "k int, v string"), 1)
    assert versions.read_version(spark, f"{run_dir}/silver/t").count() == 1


def test_reconciliation_is_logged(spark, run_dir):
    for i, method in enumerate(("rowcount", "key_hash", "full_snapshot")):
        go = one_table(spark, f"{run_dir}/{i}", raw(reconciliation={"enabled": True, "method": method}))
        go(spark.createDataFrame([(1, "a")], "k int, v string"), 0)
        row = spark.read.parquet(f"{run_dir}/{i}/control/reconciliation_log").head()
        assert (row.method, row.status) == (method, "match")
