"""Streams that follow their contract: schema over restarts, rates, measures, late rows."""

import pytest
from pyspark.sql import functions as F

from laminae import config
from laminae.operators import quality
from laminae.operators.drift import SchemaDriftError
from laminae.streaming import basics, dedup
from laminae.streaming.contract import ContractStream, late_rows, write_measured
from laminae.sources import files

RULES = [{"name": "positive", "constraint": "v > 0"}, {"name": "known", "constraint": "k IS NOT NULL", "action": "drop"}]


def stream(spark, base, mode="auto_evolve", allowed=("add_column",), rate=None):
    doc = {"target_name": "t", "source": "s", "source_schema": "x", "source_table": "t", "load": {"strategy": "stream", "stream": {"max_offsets_per_trigger": rate}}}
    doc |= {"quality": {"expectations": RULES}, "schema_drift": {"mode": mode, "allowed_changes": list(allowed), "alert_on_drift": False}}
    return ContractStream(spark, config.table_contract(doc), f"{base}/in/*", base)


def deliver(spark, base, name, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{base}/in/{name}")


def test_new_columns_and_wider_types_come_with_a_restart(spark, run_dir):
    deliver(spark, run_dir, 1, [(1, 5), (None, 6), (2, -1)], "k int, v int")
    stream(spark, run_dir).start().awaitTermination()
    deliver(spark, run_dir, 2, [(3, 7, "x"), (4, None, "y")], "k int, v int, w string")
    again = stream(spark, run_dir)
    again.start().awaitTermination()
    got = sorted((r.k, r.v, r.w) for r in again.rows().collect())
    assert got == [(1, 5, None), (2, -1, None), (3, 7, "x"), (4, None, "y")]
    assert again.known_schema().names == ["k", "v", "w"]
    assert "_ingestion_timestamp" in again.rows().columns
    measured = {r.rule_name: (r.passed, r.failed) for r in again.quality().collect()}
    assert measured == {"positive": (3, 2), "known": (4, 1)}
    # nothing new: nothing is read, no schema is written
    stream(spark, run_dir).start().awaitTermination()
    assert again.rows().count() == 4


def test_a_strict_contract_refuses_to_start(spark, run_dir):
    deliver(spark, run_dir, 1, [(1, 5)], "k int, v int")
    stream(spark, run_dir, "strict", ()).start().awaitTermination()
    deliver(spark, run_dir, 2, [(2, 6, "x")], "k int, v int, w string")
    with pytest.raises(SchemaDriftError, match="add_column not allowed: ..w"):
        stream(spark, run_dir, "strict", ()).start()
    allowed = stream(spark, run_dir, "strict")
    allowed.start().awaitTermination()
    assert allowed.rows().count() == 2 and allowed.known_schema().names == ["k", "v", "w"]


def test_the_rate_of_the_contract_sets_the_batches(spark, run_dir):
    for i in range(5):
        deliver(spark, run_dir, i, [(i, 1)], "k int, v int")
    made = stream(spark, run_dir, rate=2)
    made.start().awaitTermination()
    assert made.spark.read.parquet(f"{run_dir}/raw/t").select("_batch_id").distinct().count() == 3


def test_measures_are_taken_while_writing(spark, run_dir):
    rules = [quality.Rule("small", "id < 70"), quality.Rule("even", "id % 2 = 0", "drop")]
    rows = spark.range(100)
    assert write_measured(rows, rules, f"{run_dir}/a") == [("small", "warn", 70, 30), ("even", "drop", 50, 50)]
    assert spark.read.parquet(f"{run_dir}/a").count() == 50
    assert write_measured(rows.limit(0), rules, f"{run_dir}/b") == [("small", "warn", 0, 0), ("even", "drop", 0, 0)]
    assert write_measured(rows, [], f"{run_dir}/c") == []


def test_late_rows_are_counted(spark, run_dir):
    at = lambda minutes: F.expr(f"timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, int({minutes}), 0)")
    first = spark.range(10).select("id", at("id * 60").alias("ts"))
    later = spark.range(10, 30).select("id", at("(id - 10) * 30").alias("ts"))  # up to 09:30; the watermark is 08:00
    dropped = 0
    for name, part in (("a", first), ("b", later)):
        part.coalesce(1).write.parquet(f"{run_dir}/in/{name}")
        df = dedup.by_key(files.stream_files(spark, f"{run_dir}/in/*", schema=first.schema), ["id"], "ts", "1 hour")
        query = basics.append_files(df, f"{run_dir}/out", f"{run_dir}/checkpoint")
        query.awaitTermination()
        dropped += late_rows(query)
    assert dropped == 17 and spark.read.parquet(f"{run_dir}/out").count() == 13
