"""Periodic runs, spelling variants and exact top-k search against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from laminae.llm import dense_topk, queries, runs, spelling

SF = "/root/testdata/sf0.001"
WIDE = "doc_id long, text string, start long, runs string, word string, n long, kind int"
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "word"),
    (None, "spelling speling speling " * 3),
    (5, "the same text twice spelling spelling"),
    (5, "the same text twice spelling spelling"),
    (6, "été étés " * 9 + " İSTANBUL \x1c\x85　 ×÷×÷×÷ 12345 \U0001f600"),
    (7, "long " * 30000 + "z" * 30000),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 1, "r", "w", 2, 3) for i, t in ODD], WIDE)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], WIDE)


def brute_runs(words, min_length=6, min_exponent=4):
    found, n = [], len(words)
    for p in range(1, n // min_exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            smaller = lambda q: all(words[x] == words[x + q] for x in range(i, i + length - q))  # noqa: B023, E731
            if j > i and length >= max(min_length, min_exponent * p) and not any(smaller(q) for q in range(1, p)):
                found.append((i, length, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_texts(rng, letters):
    n = int(rng.integers(0, 60))
    words = [b"%d" % x for x in rng.integers(0, letters, n)]
    if n > 3 and rng.random() < 0.5:
        a, p = int(rng.integers(0, n)), int(rng.integers(1, 6))
        words = words[:a] + [words[a + i % min(p, n - a)] for i in range(n - a)]
    return words * int(rng.integers(1, 4))


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (5, 3), (12, 2)])
def test_runs_equal_brute_force(limits):
    rng = np.random.default_rng(2)
    for _ in range(300):
        docs = [some_texts(rng, letters) for letters in (1, 2, 3, 8)]
        assert runs.find_runs(docs, *limits) == [brute_runs(d, *limits) for d in docs]


def test_long_texts_take_time_in_proportion():
    """One class of all places, two classes, a Fibonacci word, and long copies: none is quadratic."""
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < 100_000:
        a, b = b, b + a
    noise = [b"%d" % x for x in np.random.default_rng(1).integers(0, 2, 10_000)]
    assert runs.find_runs([[b"x"] * 100_000]) == [[(0, 100_000, 1)]]
    assert runs.find_runs([[b"x", b"y"] * 50_000]) == [[(0, 100_000, 2)]]
    assert runs.find_runs([b]) == [[]]
    assert (0, 100_000, 10_000) in runs.find_runs([noise * 10])[0]


def expected_op11(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    digest = hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()).hexdigest()
    milli = math.floor(1000 * top[1] / top[2]) if found else None
    return (doc_id, len(found), *top, milli, digest, hashlib.sha256(kept.encode()).hexdigest())


def test_op11_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    short = {r.doc_id: r.text for r in docs if len(r.text or "") < 12_000}
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs) and len(short) > 150
    for i, text in short.items():
        assert got[i] == expected_op11(i, text)
    assert any(r[1] > 0 for r in got.values())


def test_runs_of_odd_rows(odd, empty):
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(odd).collect()]
    assert len(got) == len(ODD)
    assert got[0] == (1, 0, [], "") and got[1] == (2, 0, [], "") and got[2] == (3, 0, [], "")
    assert got[3] == (4, 1, [], "word") and got[4] == (None, 9, [], got[4][3]) and got[5] == got[6]
    assert got[7][2] == [(0, 18, 2)] and got[7][3].startswith("été étés İSTANBUL \x1c\x85　 ×")
    assert got[8][2] == [(0, 30_000, 1)] and got[8][3] == "long " + "z" * 30_000
    assert runs.periodic_runs(empty).count() == 0


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_index_finds_all_words_one_error_away():
    rng = np.random.default_rng(3)
    for letters in ("ab", "abcdé") * 60:
        made = lambda k, more="": list({"".join(rng.choice(list(letters + more), rng.integers(1, 8))) for _ in range(k)})  # noqa: B023, E731
        index, asked = spelling.Index(made(40)), made(20, "z")
        exact = np.array([rng.integers(0, len(q) + 1) for q in asked])
        got = list(zip(*(x.tolist() for x in index.one_error(asked, exact))))
        ends = [(q[: len(q) - e], q[len(q) - e :]) for q, e in zip(asked, exact)]
        want = [(i, j) for i, (head, tail) in enumerate(ends) for j, w in enumerate(index.words) if w.endswith(tail) and near(head, w[: len(w) - len(tail)])]
        assert got == want


def brute_variants(counts, margin=2):
    form, rows = {}, {}
    for w, n in counts.items():
        close = [x for x in counts if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(((-counts[x], x) for x in close), default=(0, None))
        form[w] = best[1] if best[1] and -best[0] >= margin * n else None
        rows[w] = (n, len(close), -best[0] if form[w] else None)
    for w, (n, n_near, form_n) in rows.items():
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, n, n_near, form_n


@pytest.mark.parametrize(("shard", "visits"), [(spelling.SHARD, spelling.VISITS), (3, 4), (1, 1)])
def test_variants_equal_brute_force(spark, shard, visits):
    """Small shards split the letters that many words share, so parts and blocks are met too."""
    rng = np.random.default_rng(5)
    counts = {}
    for letters, size in (("ab", 6), ("abé", 5), ("abcde", 9)):
        for _ in range(60):
            counts["".join(rng.choice(list(letters), rng.integers(1, size + 1)))] = int(rng.integers(1, 60))
    counts |= {"aaaaaaab" + x * k: 2**k for k in range(1, 9) for x in "cd"}
    words = spark.createDataFrame([(w, n, 7) for w, n in counts.items()], "word string, n long, kind int")
    got = sorted(map(tuple, spelling.variants(words, shard=shard, visits=visits).collect()))
    assert got == sorted(brute_variants(counts))


def expected_counts(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def test_op12_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.word: tuple(r) for r in queries.op12_spelling_variants(spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == {r[0]: r for r in brute_variants(expected_counts(rows))}
    assert sum(r[1] is not None for r in got.values()) > 20 and any(r[2] != r[1] and r[1] for r in got.values())


def test_spelling_of_odd_rows(odd, empty):
    counts = spelling.word_counts(odd, edit=spelling.drop_letter, min_letters=5, min_count=3)
    assert {r.word: r.n for r in counts.collect()} == expected_counts(ODD)
    got = {r.word: tuple(r) for r in spelling.variants(counts).collect()}
    assert got == {r[0]: r for r in brute_variants(expected_counts(ODD))}
    assert spelling.variants(spelling.word_counts(empty)).count() == 0


def brute_topk(rows, k, every):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, q in {(i, tuple(v)) for i, v in usable if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i)[:k]
        yield from ((i, rank, j, -s) for rank, (s, j) in enumerate(scored, 1))


@pytest.mark.parametrize(("shard", "block"), [(dense_topk.SHARD, dense_topk.BLOCK), (7, 2), (1, 1)])
def test_topk_equals_brute_force(spark, shard, block):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(x) for x in rng.normal(size=rng.integers(0, 9))]) for i in range(60)]
    rows += [(100 + i, [0.5, -0.25]) for i in range(12)] + [(50, [0.5, -0.25]), (50, [0.5, -0.25]), (3, [9.0])]
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")]), (250, [float("inf"), 1.0]), (None, [1.0]), (300, []), (350, [0.0, -0.0])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, kind int, shard int")
    found = dense_topk.search(frame.filter("vec_id % 10 = 0"), frame, 5, shard=shard, block=block)
    assert sorted(map(tuple, found.collect())) == sorted(brute_topk(rows, 5, 10))
    assert dense_topk.search(frame.limit(0), frame, 5).count() == 0
    assert dense_topk.search(frame.filter("vec_id = 0"), frame.filter("vec_id = 0"), 5).count() == 0


def test_topk_refuses_what_does_not_fit(spark):
    frame = spark.createDataFrame([(0, [1e300]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit"):
        dense_topk.search(frame, frame, 5).collect()
    frame = spark.createDataFrame([(0, [1e13, 1e13]), (1, [1e13, 1e13])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit"):
        dense_topk.search(frame, frame, 5).collect()


def test_op13_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).collect()]
    assert sorted(map(tuple, queries.op13_dense_topk(spark, SF).collect())) == sorted(brute_topk(rows, 5, 50))


def test_op13_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = con.execute(queries.ORACLES["op13_dense_topk"]).fetchall()
    assert sorted(want) == sorted(map(tuple, queries.op13_dense_topk(spark, SF).collect()))
