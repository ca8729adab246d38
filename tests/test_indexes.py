"""Stored indexes of vectors and words, sketches and clustered layouts against full scans."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from laminae.operators import keyword_index, vector_index, vectors
from laminae.operators.keyword_index import KeywordIndex
from laminae.operators.sketches import Sketches, SketchTable
from laminae.operators.vector_index import VectorIndex
from laminae.sinks import tables as sink


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def clustered(rng, n, groups=12, width=16):
    centres = rng.normal(size=(groups, width)) * 3
    return [(i, [float(x) for x in centres[i % groups] + rng.normal(size=width)], f"g{i % groups}") for i in range(n)]


DDL = "id long, v array<double>, g string"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    rows = clustered(np.random.default_rng(1), 900)
    odd = [(9001, None, "x"), (9002, [0.0] * 16, "x"), (9003, [float("nan")] * 16, "x"), (9004, [1.0], "x")]
    table = spark.createDataFrame(rows + odd, DDL)
    return rows, VectorIndex.build(table, str(tmp_path_factory.mktemp("ivf")), "id", "v")


def exact(rows, query, k):
    q = np.array(query)
    cos = {i: float(np.dot(q, v) / np.linalg.norm(q) / np.linalg.norm(v)) for i, v, _ in rows}
    return sorted(cos, key=lambda i: (-cos[i], i))[:k]


def test_probed_lists_hold_the_nearest_rows(spark, built):
    rows, index = built
    assert index.entries().count() == 900 and index.probes < len(index.centroids) / 3
    asked = rows[::45]
    hits = sum(len(set(exact(rows, v, 10)) & {r.id for r in index.search(v, 10).collect()}) for _, v, _ in asked)
    assert hits >= 0.9 * 10 * len(asked)
    v = asked[0][1]
    assert [r.id for r in index.search(v, 10, len(index.centroids)).collect()] == exact(rows, v, 10)
    assert index.search(v, 900, 1).count() == 900  # further lists are probed


def test_a_search_reads_only_its_lists(spark, built):
    rows, index = built
    probed = index.probed(rows[0][1], 2)
    lists = index.nearest_lists(rows[0][1], 2)
    assert {int(re.search(r"list=(\d+)", f).group(1)) for f in probed.select("v").inputFiles()} <= set(range(len(index.centroids)))
    plan = physical(probed)
    assert re.search(r"PartitionFilters: \[[^\]]*list", plan)
    files = {r[0] for r in probed.select(F.input_file_name()).distinct().collect()}
    assert {int(re.search(r"list=(\d+)", f).group(1)) for f in files} <= set(lists)


def test_random_rows_reach_the_recall_too(spark, run_dir):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=32)], "") for i in range(600)]
    index = VectorIndex.build(spark.createDataFrame(rows, DDL), run_dir, "id", "v")
    asked = [[float(x) for x in rng.normal(size=32)] for _ in range(10)]
    hits = sum(len(set(exact(rows, q, 10)) & {r.id for r in index.search(q, 10).collect()}) for q in asked)
    assert hits >= 90


def test_changes_rewrite_only_the_lists_they_touch(spark, run_dir):
    rng = np.random.default_rng(3)
    rows = {i: (i, v, g) for i, v, g in clustered(rng, 400)}
    index = VectorIndex.build(spark.createDataFrame(list(rows.values()), DDL), run_dir, "id", "v", lists=20)
    stamps = lambda: {r[0]: r[1] for r in index.entries().select("list", F.col("_metadata.file_modification_time")).groupBy("list").agg(F.max("file_modification_time")).collect()}
    before = stamps()
    moved = [(5, rows[6][1], "moved"), (1000, rows[7][1], "new"), (6, None, "unusable")]
    lists = index.upsert(spark.createDataFrame(moved, DDL))
    after = stamps()
    assert 0 < len(lists) < 6 and {n for n in before if before[n] != after.get(n)} <= set(lists)
    rows |= {5: moved[0], 1000: moved[1]}
    del rows[6]
    gone = [i for i in rows if rows[i][2] == "g3"]
    index.delete(spark.createDataFrame([(i,) for i in gone], "id long"))
    rows = {i: r for i, r in rows.items() if i not in gone}
    assert sorted((r.id, r.g) for r in index.entries().collect()) == sorted((i, g) for i, _, g in rows.values())
    # to a source without one group and with another changed; a second time nothing is written
    rows = {i: (i, v, "again" if g == "g1" else g) for i, v, g in rows.values() if g != "g2"}
    source = spark.createDataFrame(list(rows.values()), DDL)
    assert index.sync(source) and index.sync(source) == []
    assert sorted((r.id, r.g) for r in index.entries().collect()) == sorted((i, g) for i, _, g in rows.values())
    q = rows[5][1]
    assert [r.id for r in index.search(q, 8, 20).collect()] == exact(list(rows.values()), q, 8)


def test_few_queries_are_answered_by_one_scan(spark, run_dir):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=6)], "g") for i in range(400)]
    rows += [(i + 400, rows[0][1], "g") for i in range(15)] + [(900, None, "g"), (901, [0.0] * 6, "g")]  # copies: ties to the smaller key
    table = spark.createDataFrame(rows, DDL)
    index = VectorIndex.build(table, run_dir, "id", "v")
    queries = {i: rows[i][1] for i in (0, 7, 399)}
    lists = {i: [r.id for r in index.search(q, 8).collect()] for i, q in queries.items()}
    brute = vector_index.best_each(table, "id", "v", queries, 8)
    plan = brute._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 1
    for made, want in ((index.search_each(queries, 8), lists), (brute, {i: exact([r for r in rows if r[0] < 900], q, 8) for i, q in queries.items()})):
        got = {}
        for r in made.orderBy("asked", F.desc("score"), "id").collect():
            got.setdefault(r.asked, []).append(r.id)
        assert {i: set(x) for i, x in got.items()} == {i: set(x) for i, x in want.items()} and all(len(x) == 8 for x in got.values())


@pytest.fixture(scope="module")
def library(spark, tmp_path_factory):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)]
    share = 1 / np.arange(1, 61)
    rows = [(i, " ".join(rng.choice(words, int(rng.integers(0, 40)), p=share / share.sum()))) for i in range(700)]
    rows += [(1000, None), (1001, "W1, w1! W1-w2"), (1002, "Été été 3"), (1003, "same w50"), (1004, "same w50")]
    docs = spark.createDataFrame(rows, "id long, text string")
    return docs, KeywordIndex.build(docs, str(tmp_path_factory.mktemp("postings")), "id", "text")


@pytest.mark.parametrize("terms", [["w1"], ["w0", "w7", "w55"], ["W50", "same"], ["été", "3", "3"], ["nowhere"], ["nowhere", "w2"]])
def test_postings_score_like_the_scan(spark, library, terms):
    docs, index = library
    want = {r.id: r.keyword_score for r in vectors.bm25(docs, "id", "text", terms).collect()}
    got = {r.id: r.keyword_score for r in index.scores(terms).collect()}
    assert got == pytest.approx(want)
    best = [(r.id, r.keyword_score) for r in index.search(terms, 7).collect()]
    assert [i for i, _ in best] == sorted(got, key=lambda i: (-got[i], i))[:7] and dict(best) == {i: got[i] for i, _ in best}


def test_blocks_that_cannot_hold_the_best_are_not_read(spark, library, monkeypatch):
    docs, index = library
    monkeypatch.setattr(keyword_index, "FIRST", 2)
    read = []
    scored = KeywordIndex._scored
    monkeypatch.setattr(KeywordIndex, "_scored", lambda self, postings, weights: read.append(postings.select("block").distinct().count()) or scored(self, postings, weights))
    terms = ["w0", "w55"]
    got = [r.id for r in index.search(terms, 3).collect()]
    whole = {r.id: r.keyword_score for r in vectors.bm25(docs, "id", "text", terms).collect()}
    assert got == sorted(whole, key=lambda i: (-whole[i], i))[:3]
    assert sum(read) < index.postings(terms).select("block").distinct().count() / 2


def test_a_query_reads_its_terms_and_no_text(spark, library):
    _, index = library
    plan = physical(index.postings(["w3"]))
    assert re.search(r"PartitionFilters: \[[^\]]*folder", plan) and "EqualTo(term,w3)" in plan and "text" not in plan.split("ReadSchema")[1]


def test_sketches_refresh_from_new_rows_only(spark, run_dir):
    rows = spark.range(60_000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 20011).alias("k"), F.sqrt("id").alias("v"), "id")
    table = SketchTable(spark, run_dir, Sketches(("g",), ("k",), ("v",)))
    parts = [rows.where(f"id % 4 = {i}") for i in range(4)]
    parts[2].write.parquet(f"{run_dir}-part")
    for n, part in enumerate([parts[0], parts[1], spark.read.parquet(f"{run_dir}-part"), parts[3]], 1):
        assert table.refresh(part, n) and not table.refresh(rows, n)
    with pytest.raises(ValueError):
        table.refresh(rows, 9)
    exact = {r.g: r for r in rows.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("k").alias("d"), F.expr("percentile(v, array(0.1, 0.5, 0.99))").alias("q")).collect()}
    got = table.estimates({"p10": 0.1, "p50": 0.5, "p99": 0.99}).collect()
    assert len(got) == 3
    for r in got:
        e = exact[r.g]
        assert r.n == e.n and abs(r.k_distinct / e.d - 1) < 0.05
        # a share of rows below the estimate that is off by less than a hundredth
        for p, q in ((0.1, r.v_p10), (0.5, r.v_p50), (0.99, r.v_p99)):
            assert abs(q * q / 60_000 - p) < 0.01


def test_sketches_take_all_kinds_and_nulls(spark):
    rows = spark.sql("SELECT 1 AS g, DATE'2024-01-01' AS d, CAST(NULL AS STRING) AS s, 1.5 AS v UNION ALL SELECT 1, NULL, 'a', NULL UNION ALL SELECT 2, NULL, NULL, NULL")
    made = Sketches(("g",), ("d", "s"), ("v",))
    got = {r.g: (r.n, r.d_distinct, r.s_distinct) for r in made.estimates(made.state(rows)).collect()}
    assert got == {1: (2, 1, 1), 2: (1, 0, 0)}
    assert made.state(rows.limit(0)).count() == 0


def test_a_curve_lets_a_filter_on_any_key_skip_files(spark, run_dir):
    n = 40_000
    rows = spark.range(n).select(
        (F.col("id") * 7919 % 1009).alias("a"), F.concat(F.lit("k"), F.lpad((F.col("id") * 104729 % 997).cast("string"), 4, "0")).alias("b"),
        F.when(F.col("id") % 50 > 0, F.expr("date'2020-01-01' + int(id * 31 % 1501)")).alias("c"), "id",
    )
    sink.write_clustered(rows, f"{run_dir}/z", ["a", "b", "c"], 64)
    stored = spark.read.parquet(f"{run_dir}/z")
    assert stored.columns == rows.columns and stored.exceptAll(rows).isEmpty() and stored.count() == n
    sizes = stored.groupBy(F.col("_metadata.file_name").alias("f")).agg(*[x for k in "abc" for x in (F.min(k).alias(f"{k}_lo"), F.max(k).alias(f"{k}_hi"))]).collect()
    assert len(sizes) >= 48
    opened = lambda k, v: sum(r[f"{k}_lo"] is not None and r[f"{k}_lo"] <= v <= r[f"{k}_hi"] for r in sizes) / len(sizes)
    some = rows.where("id % 2003 = 7").collect()  # 64 files are 4 a key at best: a quarter, and twice that where ranges are cut
    for k in "abc":
        assert np.mean([opened(k, r[k]) for r in some]) < 0.5, k
    # by the first key alone, the others skip nothing
    sink.write_clustered(rows.limit(0), f"{run_dir}/none", ["a", "c"])
    assert spark.read.schema(rows.schema).parquet(f"{run_dir}/none").count() == 0
