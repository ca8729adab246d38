"""The training-data operators against brute force, round trips and public tokenizers."""

import base64
import hashlib
import math
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from laminae.llm import bpe, chains, fingerprints, graph, lattice, packing, prefix_forest, quality, queries, simhash_tiles, toxicity, warc
from laminae.llm.queries import PIECES, RANKS, WORD_TOKENIZER

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, score double, row long, bits long"
ODD = [
    (1, None, None),
    (2, "", "en"),
    (3, " \n\t ", "en"),
    (4, "word", None),
    (None, "a text without an id", "en"),
    (5, "the same text twice", "en"),
    (5, "the same text twice", "en"),
    (6, "é" * 5000 + " İSTANBUL \x1c\x85　 don't 'll 12345 \U0001f600!!  \n\n x", "tr"),
    (7, "long " * 20000, "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, lang, 0.5, 1, 2) for i, t, lang in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.collect()}


def tiktoken_ids(text):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    if not hasattr(tiktoken_ids, "of"):
        tiktoken_ids.of = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return tiktoken_ids.of.encode_ordinary(text)


def test_bpe_is_exact_and_round_trips(spark, odd, empty, docs, texts):
    of = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    rng = np.random.default_rng(1)
    cases = [t or "" for _, t, _ in ODD if t is None or len(t) < 20000] + list(texts.values())[:60]
    cases += ["".join(map(chr, rng.choice([32, 10, 39, 97, 98, 233, 228, 0x3B1, 0x4E2D, 0x1F600, 48, 0x1C, 0xA0], 40))) for _ in range(200)]
    for text in cases:
        assert np.frombuffer(of.encode(text), "<i4").tolist() == tiktoken_ids(text)
    ids = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    got = bpe.decode(ids, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r.decoded).decode() for r in got) == sorted(t or "" for _, t, _ in ODD)
    assert bpe.decode(bpe.encode(empty, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).count() == 0


def test_op1_digests(spark, texts):
    for r in queries.op1_byte_bpe(spark, SF).collect():
        ids = tiktoken_ids(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_warc_records(spark):
    rows = [("urn:uuid:1", "http://a/", "2024-01-01T00:00:00Z", "HTTP/1.1 404 Not Found\r\nContent-Type: text/html\r\nX-A: b", "<html lang=de><title>T</title><body><p>Ü&amp;<b>x</b></p>y</html>", 1), (None, None, None, None, None, None)]
    source = spark.createDataFrame(rows, "record_id string, target_uri string, warc_date string, http_headers string, payload string, block int")
    made = warc.derive(source)
    first = {r.warc_type: r for r in made.filter("refers_to = 'urn:uuid:1'").collect()}
    assert first["conversion"].block == "Ü&x\ny" and first["conversion"].content_length == 6
    assert "source-http-status: 404\r\n" in first["metadata"].block and "source-header: X-A: b\r\n" in first["metadata"].block
    for r in first.values():
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.refers_to_payload_digest == "sha256:" + hashlib.sha256(rows[0][4].encode()).hexdigest()
    assert made.filter("refers_to = ''").count() == 2 and warc.derive(source.limit(0)).count() == 0


def test_warc_files_hold_every_record(spark, run_dir):
    import glob
    import gzip

    made = warc.derive(queries.responses(spark.read.parquet(f"{SF}/pages.parquet")))
    warc.write(made, f"{run_dir}/warc")
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{run_dir}/warc/*.gz"))
    seen = 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        n = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
        assert rest[n : n + 4] == b"\r\n\r\n"
        data, seen = rest[n + 4 :], seen + 1
    assert seen == made.count()


def test_toxicity(spark, odd, empty):
    rng = np.random.default_rng(3)
    plain = ["tree", "house", "river", "cloud", "stone", "green"]
    rows = []
    for i in range(600):
        words = list(rng.choice(plain, 30))
        if i % 4 == 0:
            words[i % 30] = ["vile", "nastyish", "nastyous"][i % 3]
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = docs.filter("doc_id < 400").select("doc_id", "toxic").unionAll(spark.createDataFrame([(None, 1), (3, None), (1, 7)], "doc_id long, toxic int"))
    model = toxicity.train(docs, labels)
    assert 0 < len(model[0]) < 500  # sparse
    scored = docs.filter("doc_id >= 400").select("toxic", toxicity.score(model, F.col("text")).alias("s")).collect()
    assert all((r.s >= 0.5) == bool(r.toxic) for r in scored)
    assert all(0 <= r.s <= 1 for r in odd.select(toxicity.score(model, F.col("text")).alias("s")).collect())
    none = toxicity.train(odd, labels.filter("false"))
    assert {r.s for r in odd.select(toxicity.score(none, F.col("text")).alias("s")).collect()} == {0.5}
    assert empty.select(toxicity.score(none, F.col("text"))).count() == 0


def brute_chain(x, y, k, gap, cost):
    best = [0.0] * len(x)
    for j in range(len(x)):
        best[j] = k
        found = max(((best[i] + cost * (x[i] + y[i]), i) for i in range(len(x)) if x[i] < x[j] and y[i] < y[j]), default=None)
        if found and found[0] - cost * (x[j] + y[j]) > 0 and max(x[j] - x[found[1]], y[j] - y[found[1]]) <= gap:
            i = found[1]
            best[j] = found[0] - cost * (x[j] + y[j]) + min(k, x[j] - x[i], y[j] - y[i])
    return max(best)


def test_chains_by_fenwick_tree_equal_all_pairs():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(1, 30))
        pairs = np.array(sorted({(int(a), int(b)) for a, b in rng.integers(0, 60, (n, 2))}))
        x, y = pairs[:, 0], pairs[:, 1]
        paths = chains.chain(x, y, 4, 30, 0.1)
        assert sorted(i for p in paths for i in p) == list(range(len(x)))
        for p in paths:
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(p, p[1:]))
        top, score = paths[0], 4.0
        for a, b in zip(top, top[1:]):
            score += -0.1 * (x[b] - x[a] + y[b] - y[a]) + min(4, x[b] - x[a], y[b] - y[a])
        assert math.isclose(score, brute_chain(x.tolist(), y.tolist(), 4, 30, 0.1), abs_tol=1e-9)


def brute_chain_within(x, y, k, gap, cost):
    best = []
    for j in range(len(x)):
        near = [i for i in range(j) if 0 < x[j] - x[i] <= gap and 0 < y[j] - y[i] <= gap]
        gain = max((best[i] - cost * (x[j] - x[i] + y[j] - y[i]) + min(k, x[j] - x[i], y[j] - y[i]) for i in near if best[i] > cost * (x[j] - x[i] + y[j] - y[i])), default=k)
        best.append(gain)
    return best


def test_chains_take_the_best_predecessor_within_the_gap():
    rng = np.random.default_rng(15)
    for _ in range(200):
        n, gap = int(rng.integers(1, 60)), int(rng.integers(5, 40))
        pairs = np.array(sorted({(int(a), int(b)) for a, b in rng.integers(0, 80, (n, 2))}))
        x, y = pairs[:, 0], pairs[:, 1]
        paths = chains.chain_within(x, y, 4, gap, 0.1)
        assert sorted(i for p in paths for i in p) == list(range(len(x)))
        top, score = paths[0], 4.0
        for a, b in zip(top, top[1:]):
            assert 0 < x[b] - x[a] <= gap and 0 < y[b] - y[a] <= gap
            score += -0.1 * (x[b] - x[a] + y[b] - y[a]) + min(4, x[b] - x[a], y[b] - y[a])
        assert math.isclose(score, max(brute_chain_within(x.tolist(), y.tolist(), 4, gap, 0.1)), abs_tol=1e-9)


def test_passages_after_a_gap_are_found(spark):
    rng = np.random.default_rng(16)
    fresh = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    whole, one, two = fresh(400), fresh(60), fresh(60)
    rows = [(1, whole), (2, whole[:200] + fresh(50) + whole[200:]), (3, one + fresh(60) + two), (4, one + fresh(60) + two)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    found = sorted((r.doc_id, r.start_word, r.n_words) for r in chains.passages(docs).collect())
    assert found == [(2, 0, 200), (2, 250, 200), (4, 0, 60), (4, 120, 60)]


def test_passages_whose_parts_stand_in_different_earlier_places(spark):
    rng = np.random.default_rng(17)
    fresh = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    p, lines, again = fresh(80), [fresh(20) for _ in range(4)], fresh(20) * 100
    rows = [(1, p[:40] + fresh(9)), (2, fresh(9) + p[40:]), (3, fresh(70) + p + fresh(9)), (4, fresh(30) + p + fresh(30))]
    rows += [(10 + i, fresh(60) + lines[i] + fresh(60)) for i in (2, 0, 3, 1)] + [(i, fresh(40) + sum(lines, []) + fresh(40)) for i in (20, 21, 22)]
    rows += [(30, again), (31, again)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    spans = chains.passages(docs)
    covered = defaultdict(set)
    for r in spans.collect():
        assert r.n_words >= 50 and 0.8 <= r.identity <= 1
        covered[r.doc_id] |= set(range(r.start_word, r.start_word + r.n_words))
    assert covered[4] == set(range(30, 110)) and covered[3] == set(range(70, 150)) and not covered[1] | covered[2]
    assert covered[21] == covered[22] == set(range(40, 120)) and covered[31] == set(range(2000))
    assert any(r.ref_id == 3 and r.n_words == 80 for r in spans.filter("doc_id = 4").collect())


def test_repeated_passages(spark, odd, empty):
    rng = np.random.default_rng(7)
    fresh = lambda n: [f"w{i}" for i in rng.integers(0, 10**6, n)]
    passage, edited = fresh(60), None
    edited = list(passage)
    edited[20], edited[41] = "changed", "other"
    rows = [(1, fresh(80) + passage + fresh(30)), (2, passage + fresh(200)), (3, fresh(50) + edited + fresh(90)), (4, fresh(300)), (5, fresh(30) + passage[:40] + fresh(30))]
    docs = spark.createDataFrame([(i, " ".join(w), "en") for i, w in rows], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in chains.passages(docs).collect()}
    assert set(found) == {2, 3}
    assert (found[2].start_word, found[2].n_words, found[2].ref_id, found[2].ref_start_word, found[2].identity) == (0, 60, 1, 80, 1.0)
    assert (found[3].start_word, found[3].n_words, found[3].same_words) == (50, 60, 58)
    cut = {r.doc_id: r.text for r in chains.without(docs, chains.passages(docs)).collect()}
    assert cut[2] == " ".join(rows[1][1][60:]) and cut[1] == " ".join(rows[0][1]) and len(cut) == 5
    assert chains.passages(empty).count() == 0
    assert chains.without(odd, chains.passages(odd)).count() == len(ODD)


def test_packing_keeps_every_id(spark, odd, empty, docs):
    of = packing.word_tokens(WORD_TOKENIZER)
    for frame, n in ((docs, docs.count()), (odd, len(ODD)), (empty, 0)):
        pieces = packing.with_crc(packing.pack(frame, WORD_TOKENIZER, 2)).collect()
        windows = defaultdict(list)
        for p in pieces:
            windows[p.sequence_id].append(p)
        for w in windows.values():
            at = 0
            for p in sorted(w, key=lambda p: p.offset):
                assert p.offset == at
                at += p.length
            assert at <= 4096
        if frame is docs:
            rows = {r.doc_id: r.text or "" for r in frame.collect()}
            by = defaultdict(list)  # the odd rows' ids are compared in test_packing_encodes_as_the_tokenizer_does
            for p in pieces:
                by[p.doc_id].append(p)
            for doc, text in rows.items():
                ids = of.tokenizer.encode(text, add_special_tokens=False).ids + [2]
                at = 0
                for p in sorted(by[doc], key=lambda p: p.start):
                    assert p.start == at and p.doc_tokens == len(ids)
                    assert zlib.crc32(struct.pack(f"<{p.length}I", *ids[at : at + p.length])) == p.ids_crc32
                    at += p.length
                assert at == len(ids)
        assert sum(p.start == 0 for p in pieces) == n


def test_packing_encodes_as_the_tokenizer_does(docs):
    """Against a tokenizer of the test's own, called as the contract says."""
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(WORD_TOKENIZER)
    rng = np.random.default_rng(6)
    letters = list("abKTIJs'' .,;:!?%$&*#()|<>-_ \t\n\x0b\x1c\x1f019éÉÀÿß×÷ªºµİıŁłÅñ") + ["\u0301", "\u0307", "\u0308", "\u00a0", "\u2003", "\u0085", "\u2019", "中", "α", "Σ", "ς", "ﬁ", "Å", "\U0001f600", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>"]
    cases = ["".join(rng.choice(letters, rng.integers(1, 30))) for _ in range(6000)]
    cases += ["x <|endoftext|> y", "KÅİ.", "T\u0308, é\u0301. İ. K.", "", "word's it'll don't.", "long" * 5000, "é." * 3000]
    cases += [r.text or "" for r in docs.collect()]
    got = packing.WordTokens(WORD_TOKENIZER).encode([c.encode() for c in cases])
    wrong = [c for c, g in zip(cases, got) if np.frombuffer(g, "<u4").tolist() != plain.encode(c, add_special_tokens=False).ids]
    assert not wrong


def test_packing_fills_windows():
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = [int(x) for x in np.minimum(rng.lognormal(6, 1.3, int(rng.integers(1, 200))).astype(int) + 1, 20000)]
        windows = packing.Block(packing.TIERS).pack(lengths)
        seen = sorted((doc, start, n) for _, pieces in windows for doc, start, n in pieces)
        for doc, length in enumerate(lengths):
            own = [(s, n) for d, s, n in seen if d == doc]
            assert [s for s, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()] and sum(n for _, n in own) == length
        open_ = [t - sum(p[2] for p in pieces) for t, pieces in windows]
        assert sum(o > 0 for o in open_) <= 1 and sum(open_) < 256
        groups = packing.step_groups(windows, 65536)
        used = Counter()
        for (t, _), g in zip(windows, groups):
            used[g] += t
        assert all(u <= 65536 for u in used.values()) and all(used[g] > 65536 - 4096 for g in range(max(groups)))


def kneser_ney(trusted, text):
    """log2 probability by the definition, with nested formulas."""
    grams = lambda t: list(zip(["<s>", "<s>", *t.split()], ["<s>", *t.split()], [*t.split(), "</s>"]))
    c3 = Counter(g for t in trusted for g in grams(t))
    c2 = Counter()
    for (u, v, w), n in c3.items():
        c2[v, w] += n if u == v == "<s>" else 1
    c1 = Counter(w for _, w in c2)

    def disc(c):
        n = [sum(v == i for v in c.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
        d = [1 - 2 * y * n[2] / n[1] if n[1] else 0.5, 2 - 3 * y * n[3] / n[2] if n[2] else 1.0, 3 - 4 * y * n[4] / n[3] if n[3] else 1.5]
        d = [min(max(x, 0.1), i - 0.05) for i, x in enumerate(d, 1)]
        return lambda k: d[min(k, 3) - 1]

    d3, d2, d1 = disc(c3), disc(c2), disc(c1)
    all1 = sum(c1.values())
    rest = sum(d1(n) for n in c1.values()) / all1 / (len(c1) + 1)

    def p1(w):
        return (c1[w] - d1(c1[w]) if w in c1 else 0) / all1 + rest

    def p2(v, w):
        own = {b: n for (a, b), n in c2.items() if a == v}
        if not own:
            return p1(w)
        total = sum(own.values())
        return ((own[w] - d2(own[w])) if w in own else 0) / total + sum(map(d2, own.values())) / total * p1(w)

    def p3(u, v, w):
        own = {b: n for (a0, a, b), n in c3.items() if (a0, a) == (u, v)}
        if not own:
            return p2(v, w)
        total = sum(own.values())
        return ((own[w] - d3(own[w])) if w in own else 0) / total + sum(map(d3, own.values())) / total * p2(v, w)

    return sum(math.log2(p3(*g)) for g in grams(text)), len(grams(text))


@pytest.mark.parametrize("shared", [0, 20, 10**6])
def test_quality_is_kneser_ney(spark, odd, shared):
    rng = np.random.default_rng(4)
    trusted = [" ".join(rng.choice(list("abcdefgh"), int(rng.integers(3, 12)), p=[0.3, 0.2, 0.1, 0.1, 0.1, 0.1, 0.05, 0.05])) for _ in range(30)]
    model = quality.train(quality.texts(spark.createDataFrame([(i, t) for i, t in enumerate(trusted)], "doc_id long, text string")))
    asked = ["a b c", "a a a a z", "q", "", "b a d c a b h", trusted[3]]
    frame = spark.createDataFrame([(i, t, "en") for i, t in enumerate(asked)], "doc_id long, text string, lang string")
    for r in quality.perplexities(frame, model, shared=shared).collect():
        logs, n = kneser_ney(trusted, asked[r.doc_id])
        assert r.n_tokens == n and math.isclose(math.log2(r.perplexity), -logs / n, rel_tol=1e-4)


@pytest.mark.parametrize("shared", [0, 60])
def test_quality_in_rounds(spark, monkeypatch, shared):
    """Rounds over parts of the hashes add up to the same perplexities, and no round joins more than its part of the n-grams."""
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(40)], int(rng.integers(0, 60)))) for _ in range(120)] + ["", "w1 w1 w1", "w1 w1 w1"]
    docs = spark.createDataFrame([(i // 2, t, ["en", None][i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    joined, cut = [], quality.cut_lineage

    def watched(df, label="stage"):
        out = cut(df, label)
        joined.extend([out.count()] if label == "triple-values" else [])
        return out

    def found():
        joined.clear()
        model = quality.train(quality.texts(docs.filter("doc_id < 40")))
        return {(r.doc_id, r.row): (r.lang, r.copies, r.n_tokens, round(math.log2(r.perplexity), 6)) for r in quality.perplexities(docs, model, shared=shared).collect()}

    monkeypatch.setattr(quality, "cut_lineage", watched)
    once = found()
    assert len(joined) == 1 and len(once) == len(set(zip([i // 2 for i in range(len(texts))], texts, [i % 2 for i in range(len(texts))])))
    whole = sum(joined)
    monkeypatch.setattr(quality, "ROUND_ROWS", 100)
    assert found() == once and len(joined) == quality.ROUNDS and sum(joined) == whole and max(joined) < whole / 2


def test_quality_hashes_words_wherever_they_stand():
    """The words of a batch are those of bytes.split, text by text, and a word's hash does not depend on its place."""
    import pyarrow as pa

    rng = np.random.default_rng(5)
    some = [bytes(rng.choice(list(b"abcd"), int(rng.integers(1, 9))).tolist()) for _ in range(3000)]
    texts = [b"", b" ", b"a b a", " é\tx\r\n\x0by\x0c\x1fz ".encode(), b"ba ab", b" ".join(some), b"a" * 5000 + b" a", *some]
    w, at, of = quality.batch_ngrams(pa.array(texts, pa.binary()))
    words = [text.split() for text in texts]
    assert np.bincount(of, minlength=len(texts)).tolist() == [len(x) + 1 for x in words] and at.tolist() == sorted(set(at.tolist()))
    alone = {x: int(quality.batch_ngrams(pa.array([x], pa.binary()))[0][2]) for x in {x for own in words for x in own}}
    assert len(set(alone.values())) == len(alone)
    want = [h for own in words for h in [quality._START, quality._START, *(alone[x] for x in own), quality._END]]
    assert w.tolist() == want
    empty = quality.batch_ngrams(pa.array([], pa.binary()))
    assert [len(x) for x in empty] == [0, 0, 0]


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_quality_lookup(n):
    rng = np.random.default_rng(n)
    keys = np.sort(np.unique(rng.integers(0, 2**64, n, np.uint64)))
    asked = np.concatenate([keys, keys + np.uint64(1), rng.integers(0, 2**64, 50, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
    place, hit = quality.lookup(asked, keys, *quality.directory(keys))
    assert hit.tolist() == np.isin(asked, keys).tolist() and (keys[place[hit]] == asked[hit]).all()


def test_quality_rejects_junk(spark, odd, empty):
    rng = np.random.default_rng(6)
    words = [f"word{i}" for i in range(60)]
    good = [(i, " ".join(rng.choice(words, 60)), "en") for i in range(200)]
    bad = [(1000 + i, " ".join(f"{w}%%%" for w in rng.choice(words, 60)), "en") for i in range(20)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(150)] + [(1000, 0), (None, 1)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.classify(docs, labels).filter("keep").collect()}
    assert not kept & {i for i, _, _ in bad} and len(kept) >= 195
    assert quality.classify(odd, labels.filter("false")).filter("keep").agg(F.sum("copies")).first()[0] == len(ODD)
    assert quality.classify(empty, labels).count() == 0


def test_quality_learns_from_all_trusted_rows(spark, monkeypatch):
    """The model takes its counts from every trusted row outside the fold of the thresholds, however many there are."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("en").alias("lang"))
    learned, train = [], quality.train

    def counted(trusted):
        learned.append(trusted.count())
        return train(trusted)

    monkeypatch.setattr(quality, "train", counted)
    quality.classify(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    assert learned == [docs.filter(~quality.held_out("doc_id", quality.FOLDS)).count()] and learned[0] > 4000


def test_quality_keeps_languages_without_trusted_rows(spark):
    rng = np.random.default_rng(18)
    own = lambda stem: [f"{stem}{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(own("word"), 60)), "en") for i in range(200)]
    rows += [(1000 + i, " ".join(rng.choice(own("kelime"), 60)), "tr") for i in range(20)] + [(2000, " ".join(rng.choice(own("mot"), 60)), None)]
    rows += [(3000, " ".join(f"{w}%%%" for w in rng.choice(own("word"), 60)), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in quality.classify(docs, spark.createDataFrame([(i, 1) for i in range(150)], "doc_id long, quality int")).filter("keep").collect()}
    assert kept >= {*range(1000, 1020), 2000} and 3000 not in kept


def test_lattice_sums_all_segmentations():
    of = lattice.Lattice(PIECES)

    def all_ways(text):
        if not text:
            return 1.0
        total = 0.0
        for n in range(1, len(text) + 1):
            i = of.find.get(text[:n], None)
            if i is not None:
                total += math.exp(of.score[i[0]]) * all_ways(text[n:])
        if text[0] not in of.characters:
            total += math.exp(sum(of.score[b] for b in of.spelling(text[0]))) * all_ways(text[1:])
        return total

    for word in ("the", "nation", "x", "\U0001f9ff!", "retionable"):
        assert math.isclose(of.word(word.encode()), math.log(all_ways(lattice.START + word)), rel_tol=1e-9)
        counts = [0.0] * of.size
        of.expected(word.encode(), counts)
        assert counts != [0.0] * of.size
    assert of.word(b"a" * 100_000) > -math.inf


@pytest.mark.parametrize("heavy", [0, 50, 100_000])
def test_lattice_scores(spark, odd, empty, docs, texts, heavy):
    got = {r.doc_id: r for r in lattice.score(docs, PIECES, heavy=heavy).collect()}
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    tokens = lambda t: t.encode().lower().split() + [b""]
    counts = Counter(w for i, t in texts.items() if not out[i] for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    for i, t in texts.items():
        w = tokens(t)
        r = got[i]
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(w), sum(counts[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    if heavy:
        strange = lattice.score(odd, PIECES, heavy=heavy).collect()
        assert len(strange) == len(ODD) and all(math.isfinite(r.score) for r in strange)
        assert lattice.score(empty, PIECES).count() == 0


def test_lattice_scores_follow_the_model(spark):
    """Scores of whole texts from all segmentations, counts, draws and languages, as the module defines them."""
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % (9 + i % 4)}" for j in range(i % 6 + 1)) + (" The " * (i % 3)), "ab"[i % 2]) for i in range(60)]
    out = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _, _ in rows}
    tokens = lambda t: [*t.lower().encode().split(), b""]
    by = defaultdict(Counter)
    for i, t, lang in rows:
        if not out[i]:
            by[lang].update(tokens(t))
    counts = by["a"] + by["b"]
    n, c = sum(counts.values()), lattice.CONCENTRATION
    spell = lattice.DISCOUNT * len(counts) / n
    of = lattice.Lattice(PIECES, lattice.fit(spark.createDataFrame([(bytearray(w), k) for w, k in counts.items()], "word binary, n long"), PIECES))
    mass = lambda w: c * (max(counts[w] - lattice.DISCOUNT, 0) / n + spell * math.exp(of.word(w)))
    seen = sum(mass(w) for w in counts)
    own = lambda lang, w: seen * (by[lang][w] + lattice.SMOOTH * mass(w) / seen) / (sum(by[lang].values()) + lattice.SMOOTH)
    rises = lambda m, k: sum(math.log(m + j) for j in range(k))

    def expected(text):
        words = Counter(tokens(text))
        known = {w: k for w, k in words.items() if w in counts}
        ways = [math.log(0.1) + sum(rises(mass(w), k) for w, k in known.items())]
        ways += [math.log(0.9 * sum(by[x].values()) / n) + sum(rises(own(x, w), k) for w, k in known.items()) for x in "ab"]
        rest = sum(rises(mass(w), k) for w, k in words.items() if w not in counts)
        whole = math.log(sum(map(math.exp, ways))) + rest + math.lgamma(c) - math.lgamma(c + sum(words.values()))
        return whole / math.log(10)

    rows.append((next(i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 10 == 0), "never seen w1 w1 never", "c"))
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string, lang string")
    got = {r.doc_id: r.score for r in lattice.score(frame(rows), PIECES).collect()}
    for i, text, _ in rows:
        assert math.isclose(got[i], expected(text), rel_tol=1e-6), (i, got[i], expected(text))
    # what other held-out rows there are, and in which language, changes nothing
    more = [(i, "never seen again w1 w1 w5 w6", x) for i, x in zip([i for i in range(200, 400) if zlib.crc32(str(i).encode()) % 10 == 0], "abcdefgh")]
    again = {r.doc_id: (r.score, r.train_tokens) for r in lattice.score(frame(rows + more), PIECES).collect()}
    assert all(math.isclose(again[i][0], s, rel_tol=1e-12) for i, s in got.items()) and again[rows[0][0]][1] == n


def test_simhash_tiles_equal_brute_force(spark, odd, empty):
    rng = np.random.default_rng(8)
    centres = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 4)), replace=False)) for c in centres for _ in range(30)]
    bits = sorted({x - 2**64 if x >= 2**63 else x for x in near})
    for size in (50, 4096):
        links = simhash_tiles.links(spark.createDataFrame([(b,) for b in bits], "bits long"), 4, size)
        got = {r.node: r.root for r in graph.components(links).collect()}
        root = {b: b for b in bits}

        def find(b):
            while root[b] != b:
                b = root[b]
            return b

        u = np.array(bits, np.int64).view(np.uint64)
        for i, j in zip(*np.nonzero(np.bitwise_count(u[:, None] ^ u[None, :]) <= 4)):
            a, b = sorted((find(bits[i]), find(bits[j])))
            root[b] = a
        assert {b: find(b) for b in bits} == {b: got.get(b, b) for b in bits}
    found = simhash_tiles.near_duplicates(odd).collect()
    assert len(found) == len(ODD)
    by = {r.doc_id: r for r in found}
    assert by[1].bits == by[2].bits == by[3].bits == 0 and by[3].component_id == 1
    assert simhash_tiles.near_duplicates(empty).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(60)}}


@pytest.mark.parametrize("shape", ["sorted", "shuffled", "zigzag", "star"])
def test_components_take_few_rounds(spark, shape, monkeypatch):
    n = 10_000 if shape == "sorted" else 2_000
    names = list(range(n))
    if shape != "sorted":
        names = np.random.default_rng(3).permutation(n).tolist()
    if shape == "zigzag":
        names = [x for pair in zip(range(n // 2), range(n // 2, n)) for x in pair]
    edges = [(names[0], x) for x in names[1:]] if shape == "star" else list(zip(names, names[1:]))
    written = []
    cut = graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df, label: written.append(label) or cut(df, label))
    got = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert got.filter("root = 0").count() == n
    contractions = sum(x == "edges" for x in written) - 1
    assert contractions <= math.log2(n) and len(written) <= (20 if shape == "sorted" else 4 * contractions + 2 * math.log2(n)), written


def test_fingerprints(spark, odd, empty, docs, texts):
    got = {r.doc_id: r for r in queries.op9_fingerprints(spark, SF).collect()}
    order = sorted(texts)
    words = fingerprints.Words()
    prints = {i: fingerprints.fingerprint(t.encode(), words) for i, t in texts.items()}
    better = 0
    for i, after in zip(order, order[1:] + order[:1]):
        edited = fingerprints.edited_text(texts[i], texts[after])
        r = got[i]
        assert r.n_chars == len(texts[i]) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == prints[i].hex() and math.isclose(r.near_next, fingerprints.likeness(prints[i], prints[after]))
        better += r.near_edited > r.near_next
        if i % 20 == 0:
            near = [j for j in order if (int.from_bytes(prints[i]) ^ int.from_bytes(prints[j])).bit_count() <= fingerprints.RADIUS]
            assert (r.n_near, r.near_id) == (len(near), min(near))
    assert better >= 0.95 * len(order)
    small = fingerprints.with_next(odd, lambda i, t, n: (i, t, n), fingerprints.pa.schema([("a", fingerprints.pa.int64()), ("b", fingerprints.pa.string()), ("c", fingerprints.pa.string())]), rows_per_bucket=2)
    rows = sorted(((i is None, i or 0, t or ""), i, t or "") for i, t, _ in ODD)
    assert sorted((r.b, r.c) for r in small.collect()) == sorted((a[2], b[2]) for a, b in zip(rows, rows[1:] + rows[:1]))
    assert fingerprints.fingerprint_edits(empty).count() == 0


def test_prefix_forest(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((400, 16)).astype(np.float32)
    x[50:60] = x[20]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (None, x[0].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = table.filter("vec_id % 20 = 0")
    for share, shard, least in ((1.0, 150, 1.0), (0.65, 400, 0.9)):
        got = defaultdict(list)
        for r in prefix_forest.search(asked, table, 20, share=share, shard=shard).collect():
            got[r.query_id].append((r["rank"], r.id, r.score))
        assert set(got) == set(range(0, 400, 20))
        hits = 0
        for q, found in got.items():
            s = (x.astype(np.float64) * x[q].astype(np.float64)).sum(axis=1)
            s[q] = -np.inf
            best = sorted(range(400), key=lambda i: (-s[i], i))[:20]
            found.sort()
            assert [f[0] for f in found] == list(range(1, 21))
            assert all(math.isclose(f[2], s[f[1]], rel_tol=1e-12) for f in found)
            hits += len({f[1] for f in found} & set(best))
            if share == 1.0:
                assert [f[1] for f in found] == best
        assert hits >= least * 20 * len(got)
    assert prefix_forest.search(asked.limit(0), table.limit(0), 5).count() == 0
    assert prefix_forest.search(asked, table.filter("vec_id < 5"), 20).filter("query_id = 0").count() == 4


def test_prefix_forest_scores_fewer_than_half_of_the_pairs():
    rng = np.random.default_rng(10)
    x = rng.standard_normal((4000, 64))
    forest = prefix_forest.Forest(np.arange(4000), x)
    asked = np.arange(0, 4000, 40)
    found = defaultdict(set)
    for q, i, _ in forest.search(asked, x[asked], 20, prefix_forest.SHARE):
        found[q].add(i)
    assert forest.scored < 0.5 * 4000 * len(asked)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    hits = sum(len(found[q] & set(np.argsort(-s)[:20].tolist())) for q, s in zip(asked, scores))
    assert hits >= 0.9 * 20 * len(asked), hits / 20 / len(asked)


def test_pipeline_stages(spark, docs, odd):
    import corpus_pipeline

    columns = docs.columns
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SF)
        assert frame.columns == columns
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in frame.select("doc_id").collect()}
    assert 0 < frame.count() < docs.count()
    strange = spark.createDataFrame([(i, t, lang, None, len(t or "")) for i, t, lang in ODD], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, strange, SF)
        strange = out if name == "packing" else spark.createDataFrame(out.collect(), docs.schema)
        assert strange.count() > 0
    none = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_pipeline_links_texts_of_similarity_08(spark):
    from laminae.llm import shingles

    rng = np.random.default_rng(19)
    rows, wanted, apart = [], 0, set()
    for i in range(150):
        words = [f"w{j}" for j in rng.integers(0, 10**6, 200)]
        edited = list(words)
        for at in rng.choice(190, 2 if i % 2 else 4, replace=False):
            edited[at] = "changed"
        if i % 10 == 0:
            edited[:60] = [f"v{j}" for j in rng.integers(0, 10**6, 60)]  # similar by half
        a, b = ({tuple(w[j : j + 5]) for j in range(196)} for w in (words, edited))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(edited))]
        wanted += len(a & b) / len(a | b) >= 0.8
        apart |= {i} if len(a & b) / len(a | b) < 0.8 else set()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    roots = {r.hash: r.root for r in shingles.groups(docs).collect()}
    of = {r.doc_id: roots.get(r.h, r.h) for r in docs.select("doc_id", shingles.text_hash(F.col("text")).alias("h")).collect()}
    linked = {i for i in range(150) if of[2 * i] == of[2 * i + 1]}
    assert not linked & apart and len(apart) >= 15
    assert len(linked) >= 0.99 * wanted and wanted > 100
    import corpus_pipeline

    assert corpus_pipeline.one_of_each(spark, docs, SF).count() == 300 - len(linked)


def test_pipeline_links_members_of_large_buckets(spark):
    """Variants of one template, of which few are similar to each other, but nearly all through others."""
    from laminae.llm import shingles

    rng = np.random.default_rng(23)
    template = [f"w{j}" for j in rng.integers(0, 10**6, 200)]
    made = []
    for _ in range(600):
        words = list(template)
        for at in rng.choice(200, int(rng.integers(2, 7)), replace=False):
            words[at] = f"v{rng.integers(0, 12)}"
        made.append(words)
    grams = [{tuple(w[j : j + 5]) for j in range(196)} for w in made]
    root = list(range(600))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    close = [(i, j) for i in range(600) for j in range(i) if len(grams[i] & grams[j]) / len(grams[i] | grams[j]) >= 0.8]
    for i, j in close:
        root[max(find(i), find(j))] = min(find(i), find(j))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(made)], "doc_id long, text string")
    roots = {r.hash: r.root for r in shingles.groups(docs).collect()}
    of = {r.doc_id: roots.get(r.h, r.h) for r in docs.select("doc_id", shingles.text_hash(F.col("text")).alias("h")).collect()}
    together = sum(of[i] == of[j] for i, j in close)
    assert len(close) > 1000 and together >= 0.99 * len(close), (together, len(close), len(set(of.values())), len({find(i) for i in range(600)}))
    assert not [i for i in range(600) for j in range(i) if of[i] == of[j] and find(i) != find(j)]


def test_seeds_of_a_batch_are_those_of_its_texts():
    import pyarrow as pa

    rng = np.random.default_rng(31)
    made = [" ".join(f"w{j}" for j in rng.integers(0, kinds, n)).encode() for kinds in (1, 2, 3, 1000) for n in (0, 1, 5, 6, 7, 14, 15, 16, 30, 200)]
    known = chains.WordHash()
    for k, run in ((6, 10), (2, 3), (1, 1)):
        of, h, at = chains.batch_seeds(pa.array(made, pa.binary()), known, k, run)
        for i, text in enumerate(made):
            want_h, want_at = chains.seeds(chains.word_hashes(text, known), k, run)
            assert h[of == i].tolist() == want_h.tolist() and at[of == i].tolist() == want_at.tolist()
    assert [len(x) for x in chains.batch_seeds(pa.array([], pa.binary()), known, 6, 10)] == [0, 0, 0]


def test_words_of_a_batch_are_those_of_its_texts(monkeypatch):
    import pyarrow as pa

    made = ["", " ", "\t\n\v\f\r x", "A b\u00c4 \u00e4  A", "\x00 \x1c a\x85b\u00a0c", *("xyz" * n + " " + "p" * n for n in range(1, 41)), " lead", "trail \n", "ab ba aab baa", "one"]
    known = chains.WordHash()
    for piece in (1, 7, 1 << 21):
        monkeypatch.setattr(chains, "PIECE", piece)
        for rows in (made, made[::-1], [], [""], made[1:3] * 3):
            h, sizes = chains.batch_hashes(pa.array([t.encode() for t in rows], pa.binary()), known)
            want = [chains.word_hashes(t.encode(), known).tolist() for t in rows]
            assert sizes.tolist() == [len(w) for w in want] and h.tolist() == [x for w in want for x in w]


def test_quality_leaves_no_counts_on_disk(spark, docs):
    """Counts and shuffle files go when they were read for the last time, so that disk stays in proportion to the texts."""
    from pathlib import Path

    from laminae.llm import quality
    from laminae.session import CLEANUP, cut_lineage

    folder = Path(spark.conf.get("spark.checkpoint.dir"), "laminae")
    before = set(folder.glob("*"))
    kept = quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).count()
    assert kept > 0
    left = {p.name.rsplit("-", 1)[0] for p in set(folder.glob("*")) - before}
    assert left == {"perplexities", "usual", "limits"}
    blocks = lambda: spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    there = blocks()
    cut_lineage(spark.range(1000).repartition(5, "id"))
    assert blocks() <= there and spark.conf.get(CLEANUP, None) in (None, "false")


def test_pipeline_links_by_tiles_of_fingerprints(spark):
    """All similar pairs are candidates of the SimHash tiles, of small sets too, and groups are those of brute force."""
    from laminae.llm import shingles

    rng = np.random.default_rng(29)
    made, known = [], shingles.WordHash()
    for n in [6, 7, 8, 9, 10, 13, 20, 40, 90, 200] * 12:
        words = [f"w{j}" for j in rng.integers(0, 10**6, n)]
        made += [" ".join(words[: max(n - k, 5)] + [f"v{rng.integers(0, 9)}"] * (k > 2)) for k in range(6)]
    made = sorted(set(made))
    sets = [shingles.shingles(t.encode(), known) for t in made]
    rows = [(i, i, len(s), bytearray(simhash_tiles.wide_fingerprint(s).tobytes())) for i, s in enumerate(sets)]
    prints = spark.createDataFrame(rows, "hash long, root long, size long, print binary").repartition(3)
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash_tiles.close_pairs(prints, 0.8, None, tile=100).collect()}
    close = {(i, j) for j in range(len(sets)) for i in range(j) if shingles.similarity(sets[i], sets[j]) >= 0.8}
    assert len(close) > 300 and len(close - got) <= 0.001 * len(close) and len(got) < 5 * len(close)
    few = simhash_tiles.close_pairs(prints, 0.8, 1, tile=100).collect()
    marked = {r.a for r in few if r.b is None}
    assert all((min(r.a, r.b), max(r.a, r.b)) in got for r in few if r.b is not None)
    listed = {(min(r.a, r.b), max(r.a, r.b)) for r in few if r.b is not None}
    assert marked and all(i in marked and j in marked for i, j in got - listed)
    root = list(range(len(made)))
    for _ in range(len(made)):
        before = list(root)
        for i, j in close:
            root[i] = root[j] = min(root[i], root[j])
        if root == before:
            break
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    roots = {r.hash: r.root for r in shingles.groups(docs).collect()}
    of = {r.doc_id: roots.get(r.h, r.h) for r in docs.select("doc_id", shingles.text_hash(F.col("text")).alias("h")).collect()}
    assert len({(of[i], root[i]) for i in of}) == len(set(of.values())) == len(set(root))


def test_pipeline_stages_keep_columns_with_clashing_names(spark, docs):
    import corpus_pipeline

    names = ["_row", "_hash", "_copies", "_cut", "_part", "_id", "_none", "_root", "row", "hash", "id", "none", "copies", "packed", "part", "cut", "keep", "root"]
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        wide = stage(spark, wide, SF)
        assert wide.columns == [*docs.columns, *names]
        rows = wide.select("doc_id", *names).collect()
        assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
    assert corpus_pipeline.pack(spark, wide, SF).count() > 0


def test_toxicity_takes_one_text_of_each_id(spark):
    rows = [(i, f"plain words {i}", 0) for i in range(20)] + [(100, f"nasty {i}", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    at, _ = toxicity.train(docs, docs, settings=toxicity.Ftrl(l1=0.0))
    of = toxicity.Features(toxicity.BITS)
    known = {int(p) for p in at}
    held = [i for i in range(200) if set(map(int, of.of(f"nasty {i}"))) <= known]
    assert len(held) == 1


def test_pipeline_removes_rows_not_ids(spark):
    import corpus_pipeline

    rng = np.random.default_rng(20)
    a, b, c, d = (" ".join(f"w{j}" for j in rng.integers(0, 10**6, 80)) for _ in range(4))
    rows = [(1, a), (1, a), (2, a), (2, b), (None, a), (3, c), (3, c), (None, d), (None, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.one_of_each(spark, docs, SF).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (3, c), (None, d)], key=str)


def test_op2_against_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    want = con.execute(queries.ORACLES["op2_warc_derivatives"]).fetchdf().sort_values("record_id").reset_index(drop=True)
    got = queries.op2_warc_derivatives(spark, sf).toPandas().sort_values("record_id").reset_index(drop=True)
    assert (got[want.columns] == want).all().all()


def test_batches_are_bounded_by_bytes_unless_the_session_says_otherwise(spark):
    import pyarrow as pa

    from laminae.llm.columns import bound_batches, texts

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["rows", "bytes"])

    try:
        spark.conf.unset(key)
        long = spark.range(0, 40, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 100_000).alias("text"))
        found = texts(long).mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in found) == 40 and max(r["bytes"] for r in found) < 6_000_000
        spark.conf.set(key, "1m")
        bound_batches(spark)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
