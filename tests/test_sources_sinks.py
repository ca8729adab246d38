"""Readers, writers, JDBC through embedded Derby, versions and reverse ETL."""

import pytest
from pyspark.sql import functions as F

from laminae.config import ContractError, table_contract
from laminae.session import scratch_path, shared_dir
from laminae.sinks import reverse_etl, versions
from laminae.sinks import tables as sink
from laminae.sources import dispatch, files, jdbc, logs, tables

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def derby(spark):
    source = jdbc.JdbcSource("jdbc:derby:memory:lam;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver")
    orders = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    orders.write.format("jdbc").options(**source.option_map()).option("dbtable", "ORDERS").mode("overwrite").save()
    return source


def test_jdbc_split_read_and_pushed_filter(spark, derby):
    df = jdbc.scan_jdbc(spark, derby, "ORDERS", split_column="o_orderkey", partitions=3)
    assert df.count() == 1500 and df.rdd.getNumPartitions() == 3
    newer = jdbc.scan_jdbc_incremental(spark, derby, "ORDERS", "o_orderkey", 1000)
    assert newer.count() == 499
    assert "PushedFilters: [*IsNotNull(o_orderkey), *GreaterThan(o_orderkey,1000)]" in plan(newer)
    assert jdbc.foreign_table(spark, derby, "ORDERS", "remote_orders").count() == spark.table("remote_orders").count()


def test_jdbc_urls():
    assert jdbc.server_url("postgresql", "h", "d") == "jdbc:postgresql://h:5432/d"
    assert jdbc.server_url("sqlserver", "h", "d", 7).startswith("jdbc:sqlserver://h:7;database=d;")
    with pytest.raises(ValueError):
        jdbc.server_url("other", "h", "d")


def test_incremental_filter_reaches_parquet(spark):
    df = tables.above_watermark(spark.read.parquet(f"{SF}/orders.parquet"), "o_orderkey", "700").select("o_orderkey")
    text = plan(df)
    assert "GreaterThan(o_orderkey,700)" in text and "ReadSchema: struct<o_orderkey:bigint>" in text
    assert tables.above_watermark(df, "o_orderkey", None) is df


def test_hints_rescue_and_metadata(spark, run_dir):
    lines = ['{"id": 1, "v": "2.5"}', '{"id": 2, "v": "3.5"}', "{broken", '{"id": "x", "v": "1"}']
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(f"{run_dir}/j")
    df = files.scan_rescued(spark, f"{run_dir}/j", "json", "id INT, v STRING")
    good, bad = files.split_rescued(df)
    assert sorted(r.id for r in good.collect()) == [1, 2] and len(bad.collect()) == 2
    hinted = files.scan_with_hints(spark, f"{run_dir}/j", "json", "v DECIMAL(4,2), extra INT")
    assert dict(hinted.dtypes)["v"] == "decimal(4,2)" and dict(hinted.dtypes)["extra"] == "int"
    full = files.scan_with_hints(spark, f"{run_dir}/j", "json", "id BIGINT", full=True)
    assert full.dtypes == [("id", "bigint")]
    row = files.with_file_metadata(spark.read.parquet(f"{SF}/region.parquet")).head()
    assert row._source_file.endswith("region.parquet") and row._source_file_size > 0


def test_rescue_on_a_stream(spark, run_dir):
    spark.createDataFrame([('{"id": 1}',), ("{broken",)], "value string").coalesce(1).write.text(f"{run_dir}/s")
    schema = "id INT, _corrupt_record STRING"
    stream = files.stream_files(spark, f"{run_dir}/s", "json", schema).withColumn("has_parsing_errors", F.col("_corrupt_record").isNotNull())
    good, bad = files.split_rescued(stream)
    for name, part in (("good", good), ("bad", bad)):
        part.writeStream.format("parquet").option("path", f"{run_dir}/{name}").option("checkpointLocation", f"{run_dir}/c{name}").trigger(availableNow=True).start().awaitTermination(60)
    assert spark.read.parquet(f"{run_dir}/good").collect()[0].id == 1
    assert spark.read.parquet(f"{run_dir}/bad").count() == 1


def test_listing_reads_no_content(spark):
    df = files.list_folder(spark, SF, "*.parquet")
    assert df.count() == 14 and "content" not in plan(df).split("ReadSchema")[1]


def test_stream_evolution_modes(spark, run_dir):
    spark.createDataFrame([(1,)], "a int").write.json(f"{run_dir}/e")
    spark.createDataFrame([(2, "x")], "a int, b string").write.mode("append").json(f"{run_dir}/e")
    assert set(files.stream_files(spark, f"{run_dir}/e", "json").columns) == {"a", "b"}
    strict = files.stream_files(spark, f"{run_dir}/e", "json", "a INT", evolve=False)
    assert strict.columns == ["a"] and strict.isStreaming


def test_log_options():
    got = logs.kafka_options("b:9092", ["a", "b"], "latest", 500, "SASL_SSL", {"mechanism": "PLAIN", "username": "u", "password": "p"})
    assert got["subscribe"] == "a,b" and got["startingOffsets"] == "latest" and got["maxOffsetsPerTrigger"] == "500"
    assert 'username="u"' in got["kafka.sasl.jaas.config"] and got["kafka.sasl.mechanism"] == "PLAIN"
    assert logs.change_topic("s", "t") == "dbserver1.s.t" and logs.change_topic("s", "t", "mine") == "mine"
    hub = logs.event_hub_options("ns", "hub", "secret")
    assert hub["kafka.bootstrap.servers"].endswith(":9093") and hub["subscribe"] == "hub"


def contract(**load):
    return table_contract({"target_name": "orders", "source": "s", "source_schema": "", "source_table": "orders", "load": load})


def test_dispatch(spark, derby):
    by_file = dispatch.read_batch(spark, contract(strategy="snapshot"), {"type": "files", "path": SF + "/{table}.parquet"})
    assert by_file.count() == 1500
    inc = contract(strategy="incremental", watermark_column="o_orderkey")
    assert dispatch.read_batch(spark, inc, {"type": "files", "path": SF + "/{table}.parquet"}, 1000).count() == 499
    settings = {"type": "jdbc", "url": derby.url, "driver": derby.driver, "split_column": "o_orderkey", "partitions": 2}
    assert dispatch.read_batch(spark, inc, settings, 1000).count() == 499
    by_file.createOrReplaceTempView("orders")
    assert dispatch.read_batch(spark, contract(strategy="snapshot"), {"type": "catalog"}).count() == 1500
    with pytest.raises(ContractError):
        dispatch.read_batch(spark, inc, {"type": "fax"})
    stream = contract(strategy="stream", stream={"source_type": "files"})
    got = dispatch.read_stream(spark, stream, {"path": SF + "/{table}.parquet", "format": "parquet"})
    assert got.isStreaming
    with pytest.raises(ContractError):
        dispatch.read_stream(spark, contract(strategy="stream", stream={"source_type": "fax"}), {})


def test_tables_and_exports(spark, run_dir):
    part = spark.read.parquet(f"{SF}/part.parquet")
    sink.write_table(part, "lam_managed")
    sink.write_table(part, "lam_external", path=run_dir)
    assert spark.table("lam_managed").count() == spark.read.parquet(f"{run_dir}/lam_external").count() == 200
    sink.export_files(part, f"{run_dir}/csv", "csv")
    assert spark.read.csv(f"{run_dir}/csv", header=True).columns == part.columns
    sink.table_from_files(spark, "lam_ctas", f"{run_dir}/csv", "csv", header="true")
    assert spark.table("lam_ctas").count() == 200


def test_layouts(spark, run_dir):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    sink.write_partitioned(orders, f"{run_dir}/p", ["o_orderstatus"])
    pruned = spark.read.parquet(f"{run_dir}/p").where("o_orderstatus = 'F'")
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan(pruned)
    assert pruned.count() == orders.where("o_orderstatus = 'F'").count()
    sink.write_clustered(orders, f"{run_dir}/c", ["o_custkey", "o_orderdate"], 4)
    spans = spark.read.parquet(f"{run_dir}/c").groupBy(F.input_file_name()).agg(F.min("o_custkey").alias("lo"), F.max("o_custkey").alias("hi"))
    ranges = sorted((r.lo, r.hi) for r in spans.collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:])) and len(ranges) == 4
    with pytest.raises(ValueError):
        sink.write_clustered(orders, f"{run_dir}/d", list("abcde"))
    sink.write_bucketed(orders, "lam_b1", ["o_custkey"], 4)
    sink.write_bucketed(spark.read.parquet(f"{SF}/customer.parquet").withColumnRenamed("c_custkey", "o_custkey"), "lam_b2", ["o_custkey"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = spark.table("lam_b1").join(spark.table("lam_b2"), "o_custkey")
    text = plan(joined)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text


def test_compaction(spark, run_dir):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    orders.repartition(20).write.parquet(f"{run_dir}/small")
    assert sink.compact(spark, f"{run_dir}/small", f"{run_dir}/big") == 1
    assert files.list_folder(spark, f"{run_dir}/big", "*.parquet").count() == 1
    assert spark.read.parquet(f"{run_dir}/big").count() == 1500


def test_versions_and_audit(spark, run_dir):
    df = spark.createDataFrame([(1,)], "a int")
    path = f"{run_dir}/t"
    assert versions.read_version(spark, path) is None
    assert [versions.write_version(df, path) for _ in range(3)] == [1, 2, 3]
    import os

    os.makedirs(f"{path}/v=4")  # a write that never committed
    assert versions.latest_version(spark, path) == 3
    assert versions.drop_versions(spark, path, keep=2) == [1]
    audit = f"{run_dir}/a"
    for i, day in enumerate(["2024-01-01", "2024-03-01", "2024-03-02"]):
        versions.append_audit(df, audit, i, day)
    assert versions.expire_audit(spark, audit, "2024-04-10", 40) == [0]  # exactly 40 days old is kept
    assert spark.read.parquet(audit).count() == 2


def test_reverse_etl(spark, derby):
    ddl = "k int, v string"
    one = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], ddl)
    two = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], ddl)
    reverse_etl.sync(one, ["k"], derby, "COPY")
    read = lambda t: sorted(map(tuple, jdbc.scan_jdbc(spark, derby, t).collect()))
    assert read("COPY") == [(1, "a"), (2, "b"), (3, "c")]
    reverse_etl.sync(two, ["k"], derby, "COPY", "TRIGGERED", last_synced=one)
    assert read("COPY_upserts") == [(2, "B"), (4, "d")] and read("COPY_deletes") == [(3,)]
    with pytest.raises(ValueError):
        reverse_etl.sync(one, ["k"], derby, "COPY", "NEVER")


def test_reverse_etl_stream(spark, derby, run_dir):
    spark.read.parquet(f"{SF}/region.parquet").write.parquet(f"{run_dir}/region")
    stream = files.stream_files(spark, f"{run_dir}/region")
    reverse_etl.sync_stream(stream, derby, "REGION_COPY", f"{run_dir}/ck").awaitTermination(60)
    assert jdbc.scan_jdbc(spark, derby, "REGION_COPY").count() == 5
    with pytest.raises(ValueError):
        reverse_etl.sync_stream(stream, derby, "X", f"{run_dir}/ck2", "SNAPSHOT")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_formats_are_written_in_files_of_bounded_size(spark, monkeypatch):
    """A file of a format that is read whole (XML) is one task's, so its size must not grow with the table."""
    from laminae.plans import q_core

    monkeypatch.setattr(q_core, "FILE_ROWS", 50)
    back = q_core.read_formats(spark, SF)
    rows = back.groupBy("fmt", F.input_file_name().alias("file")).count().groupBy("fmt").agg(F.max("count").alias("most"), F.sum("count").alias("n")).collect()
    whole = spark.read.parquet(f"{SF}/part.parquet").count()
    assert len(rows) == 5 and all(r.most <= 50 and r.n == whole for r in rows)
