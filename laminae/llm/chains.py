"""Fuzzy repeated passages by collinear chaining of shared k-mer seeds.

Seeds are k-word sequences sampled by minimizers: of each run of `run` neighbouring k-mers the one with the
smallest hash, so any shared stretch of k + run - 1 words has a seed in common. Each seed is joined
with its first occurrence in the corpus (smallest document, then place), and so is each run of 2, 4 and 8
repeated seeds that no single one of these places holds: a longer passage finds its own first holder. That
makes a fixed number of matches a seed and never their square. The matches of one pair of documents are chained: in order of place in
both texts, each match takes, of the predecessors within the gap in both texts, the one with the best score
less a cost for the words skipped. Chains are then aligned word by word, extended at both ends, and passages
of at least `least` words and `similar` identity are returned, shorter ones too where they adjoin or overlap
to `least` words, over different places.

Defined cases: null and empty texts have no seeds; rows that share an id are one document, its texts told
apart by a hash, and a null id takes part in nothing; passages within one document are matched as well,
to their first place in it; ties of hashes go to the later place; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from laminae.llm import bits
from laminae.llm.columns import texts
from laminae.session import cut_lineage

K, RUN, LEAST, SIMILAR, GAP, COST, EXTEND = 6, 10, 50, 0.8, 40, 0.1, 24
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile(b"[\\x20\\x09-\\x0D]").search
PIECE = 1 << 21
_IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_WORDS = re.compile("[^\\x20\\x09-\\x0D]+").finditer


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, 5)
        return found


def word_hashes(text: bytes, known: WordHash) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def seeds(h: np.ndarray, k: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the sampled k-mers."""
    n = len(h) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    mers = np.zeros(n, np.uint64)
    for i in range(k):
        mers = (mers ^ h[i : i + n]) * _MIX
        mers ^= mers >> np.uint64(31)
    size = min(run, n)
    windows = np.lib.stride_tricks.sliding_window_view(mers[::-1], size)[::-1]
    last = np.arange(len(windows)) + size - 1 - windows.argmin(axis=1)
    at = np.unique(last)
    changed = np.ones(len(at), bool)  # of a run of one repeated k-mer, one seed
    changed[1:] = mers[at[1:]] != mers[at[:-1]]
    at = at[changed]
    return mers[at], at.astype(np.int32)


def batch_hashes(texts_: pa.Array, known: WordHash) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes of all texts of a batch in a row, and each text's number of words, without an object for each word."""
    data = b" ".join(texts_.to_pylist()).lower() + bytes(8)
    ends = np.cumsum(pc.binary_length(texts_).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    hashes, places, low = [], [], 0
    while low < len(data) - 8:
        cut = _SPACE(data, min(len(data), low + PIECE), len(data) - 8)  # pieces end between words
        high = cut.start() if cut else len(data) - 8
        inside = np.zeros(high - low + 2, np.int8)
        inside[1:-1] = ~_IS_SPACE[np.frombuffer(data, np.uint8, high - low, low)]
        edge = np.diff(inside)
        starts, stops = np.flatnonzero(edge > 0) + low, np.flatnonzero(edge < 0) + low
        hashes.append(_hashes(data, starts, stops - starts, known))
        places.append(starts)
        low = high + 1
    h, at = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((hashes, np.uint64), (places, np.int64)))
    return h, np.diff(np.searchsorted(at, ends), prepend=0)


def _hashes(data: bytes, starts: np.ndarray, sizes: np.ndarray, known: WordHash) -> np.ndarray:
    """XXH64 (seed 5) of stretches of data, all at once; those of 32 bytes and more one by one. Eight bytes follow the last."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, by: (x << np.uint64(by)) | (x >> np.uint64(64 - by))
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = p5 + np.uint64(5) + sizes.astype(np.uint64)
    for i in range(0, 24, 8):
        w = np.flatnonzero(sizes >= i + 8)
        h[w] = turn(h[w] ^ (turn(eight[starts[w] + i] * p2, 31) * p1), 27) * p1 + p4
    at, left = starts + sizes // 8 * 8, sizes % 8
    w = np.flatnonzero(left >= 4)
    h[w] = turn(h[w] ^ ((eight[at[w]] & np.uint64(0xFFFFFFFF)) * p1), 23) * p2 + p3
    at, left = at + left // 4 * 4, left % 4
    for i in range(3):
        w = np.flatnonzero(left > i)
        h[w] = turn(h[w] ^ ((eight[at[w] + i] & np.uint64(0xFF)) * p5), 11) * p1
    for by, p in ((33, p2), (29, p3)):
        h = (h ^ (h >> np.uint64(by))) * p
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(sizes >= 32).tolist():
        h[i] = known[data[starts[i] : starts[i] + sizes[i]]]
    return h


def batch_seeds(texts_: pa.Array, known: WordHash, k: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The seeds of each text of a batch, found for all texts at once: number of the text, hash and place."""
    h, sizes = batch_hashes(texts_, known)
    n = np.maximum(sizes - k + 1, 0)  # k-mers of each text
    first = np.cumsum(n) - n
    of = np.repeat(np.arange(len(n)), n)
    mers = np.zeros(max(0, len(h) - k + 1), np.uint64)
    for i in range(k):
        mers = (mers ^ h[i : i + len(mers)]) * _MIX
        mers ^= mers >> np.uint64(31)
    mers = mers[np.repeat(np.cumsum(sizes) - sizes - first, n) + np.arange(len(of))]  # without those that reach over an end
    least, last, size = mers, np.arange(len(mers)), 1
    while size < run and len(least) > 0:  # windows of twice the size, until they are as long as a run; ties go to the later place
        by = min(size, run - size)
        lower = least[by:] <= least[: len(least) - by]
        least = np.where(lower, least[by:], least[: len(least) - by])
        last = np.where(lower, last[by:], last[: len(last) - by])
        size += by
    last = last[of[run - 1 :] == of[: len(last)]] if len(of) >= run else last[:0]
    short = np.flatnonzero((n > 0) & (n < run))
    ends = [first[i] + n[i] - 1 - mers[first[i] : first[i] + n[i]][::-1].argmin() for i in short]
    at = np.unique(np.concatenate([last, np.array(ends, np.int64)]))
    changed = np.ones(len(at), bool)  # of a run of one repeated k-mer, one seed
    changed[1:] = (mers[at[1:]] != mers[at[:-1]]) | (of[at[1:]] != of[at[:-1]])
    at = at[changed]
    return of[at], mers[at], (at - first[of[at]]).astype(np.int32)


def _paths(best: list[float], before: list[int]) -> list[list[int]]:
    used, chains = [False] * len(best), []
    for j in sorted(range(len(best)), key=lambda j: -best[j]):
        path = []
        while j >= 0 and not used[j]:
            used[j] = True
            path.append(j)
            j = before[j]
        if path:
            chains.append(path[::-1])
    return chains


def chain(x: np.ndarray, y: np.ndarray, k: int, gap: int, cost: float) -> list[list[int]]:
    """Chains of matches (x, y), each with the places of its matches in order; sorted by x, then y.

    best(j) = k + max over i with x_i < x_j, y_i < y_j of best(i) - cost * (skipped words), found as the prefix
    maximum of best(i) + cost * (x_i + y_i) over y; a match that gains nothing begins a chain. The gap is tested after the
    maximum only, so a far chain hides nearer ones; passages are found by chain_within."""
    ranks = np.unique(y)
    rank = (np.searchsorted(ranks, y) + 1).tolist()
    xs, ys, size = x.tolist(), y.tolist(), len(ranks)
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (size + 1)
    best, before, entered = [0.0] * len(xs), [-1] * len(xs), 0
    for j in range(len(xs)):
        while xs[entered] < xs[j]:  # matches at the same place in x never follow each other
            i, entered = entered, entered + 1
            entry, r = (best[i] + cost * (xs[i] + ys[i]), i), rank[i]
            while r <= size:
                if entry > tree[r]:
                    tree[r] = entry
                r += r & -r
        found, r = (-np.inf, -1), rank[j] - 1
        while r:
            if tree[r] > found:
                found = tree[r]
            r -= r & -r
        i, gain = found[1], found[0] - cost * (xs[j] + ys[j])
        best[j] = float(k)
        if i >= 0 and gain > 0 and max(xs[j] - xs[i], ys[j] - ys[i]) <= gap:
            new = min(k, xs[j] - xs[i], ys[j] - ys[i])
            best[j], before[j] = gain + new, i
    return _paths(best, before)


def chain_within(x: np.ndarray, y: np.ndarray, k: int, gap: int, cost: float) -> list[list[int]]:
    """Chains of matches (x, y), each with the places of its matches in order; sorted by x, then y.

    best(j) = max over i with 0 < x_j - x_i <= gap, 0 < y_j - y_i <= gap of best(i) - cost * (skipped words) +
    min(k, x_j - x_i, y_j - y_i); a match that gains nothing begins a chain. The matches within gap in x are looked through one by one: they
    are at most gap times the few partners of a place."""
    xs, ys = x.tolist(), y.tolist()
    best, before, oldest, same = [0.0] * len(xs), [-1] * len(xs), 0, 0
    for j in range(len(xs)):
        xj, yj = xs[j], ys[j]
        if xs[same] < xj:
            same = j  # matches at the same place in x never follow each other
        while xs[oldest] < xj - gap:
            oldest += 1
        best[j] = float(k)
        for i in range(oldest, same):
            dx, dy = xj - xs[i], yj - ys[i]
            if 0 < dy <= gap and (gain := best[i] - cost * (dx + dy)) > 0:
                value = gain + min(k, dx, dy)
                if value > best[j] or before[j] < 0:
                    best[j], before[j] = value, i
    return _paths(best, before)


def align(a: np.ndarray, b: np.ndarray) -> int:
    """Words that a longest common subsequence of two stretches keeps."""
    if len(a) == 0 or len(b) == 0:
        return 0
    row = np.zeros(len(b) + 1, np.int32)
    for w in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == w)))
    return int(row[-1])


def reach(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """How far two texts still agree from their beginnings, differing words allowed in between: the
    ends of the best-scoring stretch (agreeing word 1, other word -2) on near diagonals."""
    best, end = 0, (0, 0)
    for shift in (0, 1, -1):
        u, v = a[max(0, shift) :], b[max(0, -shift) :]
        n = min(len(u), len(v))
        if not n:
            continue
        score = np.cumsum(np.where(u[:n] == v[:n], 1, -2)) - 2 * abs(shift)
        i = int(score.argmax())
        if score[i] > best:
            best, end = int(score[i]), (i + 1 + max(0, shift), i + 1 + max(0, -shift))
    return end


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and part, which tells rows of one id apart."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return texts(df, id_col, text_col, part=F.crc32(text).cast("long")).filter("doc_id IS NOT NULL")


def matches(docs: DataFrame, k: int = K, run: int = RUN, gap: int = GAP) -> DataFrame:
    """doc_id, part, pos, ref_id, ref_part, ref_pos: each seed with its first occurrence elsewhere, and the seeds
    of runs of 2, 4 and 8 with the first occurrence of the whole run.

    The first pass counts seeds and finds their first occurrences, combined in the map tasks; the second
    reads the texts again and sends only those seeds on that may be repeated."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in batches:
            of, h, at = batch_seeds(batch.column(1), known, k, run)
            order = np.lexsort((h, of))  # stable: the first of equal seeds is that of the first place
            of, h, at = of[order], h[order], at[order]
            fresh = np.ones(len(h), bool)
            fresh[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
            begin = np.flatnonzero(fresh)
            n = np.diff(np.append(begin, len(h))).astype(np.int32)
            rows = pa.array(of[begin])
            columns = [pa.array(h[begin].view(np.int64)), batch.column(0).take(rows), batch.column(2).take(rows), pa.array(at[begin]), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["seed", "doc_id", "part", "pos", "n"])

    found = docs.mapInArrow(first, "seed long, doc_id long, part long, pos int, n int").groupBy("seed")
    summed = found.agg(F.sum("n").alias("n"), F.min("doc_id").alias("ref_id"), F.min_by("part", "doc_id").alias("ref_part"), F.min_by("pos", "doc_id").alias("ref_pos"))
    repeated = cut_lineage(summed.filter("n > 1").drop("n"), "seeds")
    table = docs.sparkSession.sparkContext.broadcast(bits.build(repeated, "seed"))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = WordHash(), np.frombuffer(table.value, np.uint64)
        for batch in batches:
            of, h, at = batch_seeds(batch.column(1), known, k, run)
            keep = bits.maybe(held, h)
            rows = pa.array(of[keep])
            yield pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), batch.column(0).take(rows), batch.column(2).take(rows), pa.array(at[keep])], ["seed", "doc_id", "part", "pos"])

    placed = docs.mapInArrow(again, "seed long, doc_id long, part long, pos int")
    found = _with_runs(placed.join(repeated, "seed"), gap)
    same = (F.col("doc_id") == F.col("ref_id")) & (F.col("part") == F.col("ref_part")) & (F.col("pos") <= F.col("ref_pos"))
    alone = found.filter("key IS NULL").select(*_MATCH).filter(~same)
    runs = found.filter("key IS NOT NULL").select("key", "doc_id", "part", "pos", "offsets")
    holders = runs.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "part", "pos")).alias("ref")).filter("n > 1")
    holders = holders.select("key", F.col("ref.doc_id").alias("ref_id"), F.col("ref.part").alias("ref_part"), F.col("ref.pos").alias("ref_pos"))
    joined = runs.join(holders, "key").filter(~same).withColumn("by", F.explode("offsets"))
    return alone.unionAll(joined.withColumn("pos", F.col("pos") + F.col("by")).withColumn("ref_pos", F.col("ref_pos") + F.col("by")).select(*_MATCH))


_MATCH = ["doc_id", "part", "pos", "ref_id", "ref_part", "ref_pos"]


def split_runs(seed: np.ndarray, pos: np.ndarray, refs: np.ndarray, gap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of one text's repeated seeds, in order of place: keys, places and offsets of the runs of 2, 4 and 8 whose
    seeds first stand in different places (refs: document, part, place). Seeds and distances decide about this
    alone, so all copies of a run agree; where one place holds the run, its seeds' matches lead there anyway."""
    step = np.diff(pos)
    near = step <= gap
    one = near & (refs[:2, 1:] == refs[:2, :-1]).all(axis=0) & (np.diff(refs[2]) == step)
    key, size = seed, 1
    while size < 8 and len(key) > size:
        far = (pos[size : size + len(key) - size] - pos[: len(key) - size]).astype(np.uint64)
        key = ((key[:-size] * _MIX) ^ (key[size:] + far * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(size))) * _MIX
        key ^= key >> np.uint64(29)
        size *= 2
        window = np.lib.stride_tricks.sliding_window_view
        at = np.flatnonzero(window(near, size - 1).all(axis=1) & ~window(one, size - 1).all(axis=1))
        yield key[at], pos[at], window(pos, size)[at] - pos[at, None]


def _with_runs(found: DataFrame, gap: int) -> DataFrame:
    """The matches, and with a key those runs of neighbouring seeds that no single first occurrence holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: np.ndarray | None = None
        for batch in batches:
            frame = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(7)])
            if held is not None:
                frame = np.concatenate([held, frame], axis=1)
            borders = np.flatnonzero((frame[:2, 1:] != frame[:2, :-1]).any(axis=0)) + 1
            last = borders[-1] if len(borders) else 0
            held = frame[:, last:]  # the next batch may go on with this text
            if last:
                yield from table(frame[:, :last], borders[:-1])
        if held is not None and held.shape[1]:
            yield from table(held, np.zeros(0, int))

    def table(frame: np.ndarray, borders: np.ndarray) -> Iterator[pa.RecordBatch]:
        fresh = np.ones(frame.shape[1], bool)  # equal rows of one id have the same places
        fresh[1:] = (frame[:3, 1:] != frame[:3, :-1]).any(axis=0)
        none = pa.nulls(int(fresh.sum()), pa.int64())
        yield batch_of(frame[:6, fresh], none, pa.nulls(len(none), pa.list_(pa.int32())))
        edges = [0, *borders.tolist(), frame.shape[1]]
        for a, b in zip(edges, edges[1:]):
            text = frame[:, a:b][:, fresh[a:b]]
            for key, at, by in split_runs(text[6].view(np.uint64), text[2], text[3:6], gap):
                if len(key):
                    rows = np.zeros((6, len(key)), np.int64)
                    rows[:2], rows[2] = text[:2, :1], at
                    yield batch_of(rows, pa.array(key.view(np.int64)), pa.array(by.tolist(), pa.list_(pa.int32())))

    def batch_of(rows: np.ndarray, key: pa.Array, offsets: pa.Array) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
        return pa.RecordBatch.from_arrays([*(pa.array(r, pa.int64()).cast(t) for r, t in zip(rows, kinds)), key, offsets], [*_MATCH, "key", "offsets"])

    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.select(*_MATCH, "seed").repartition(n, "doc_id", "part").sortWithinPartitions("doc_id", "part", "pos")
    made = "doc_id long, part long, pos int, ref_id long, ref_part long, ref_pos int, key long, offsets array<int>"
    return cut_lineage(dealt.mapInArrow(run, made), "runs")


_CHAIN = "chain long, doc_id long, part long, x_from int, x_to int, ref_id long, ref_part long, y_from int, y_to int, xs binary, ys binary"


def chains(found: DataFrame, k: int = K, span: int = LEAST - 2 * (K + RUN), gap: int = GAP, cost: float = COST) -> DataFrame:
    """Chains of at least span words. A document's matches meet in one task, as many as its seeds."""
    pair = ["doc_id", "part", "ref_id", "ref_part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        held: tuple | None = None
        for batch in batches:
            frame = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)])
            if held is not None:
                frame = np.concatenate([held, frame], axis=1)
            borders = np.flatnonzero((frame[:4, 1:] != frame[:4, :-1]).any(axis=0)) + 1
            last = borders[-1] if len(borders) else 0
            held = frame[:, last:]  # the next batch may go on with this pair
            rows = list(link(frame[:, :last], borders[:-1]))
            yield batch_of(rows, number)
            number += len(rows)
        if held is not None and held.shape[1]:
            yield batch_of(list(link(held, np.zeros(0, int))), number)

    def link(frame: np.ndarray, borders: np.ndarray) -> Iterator[tuple]:
        edges = [0, *borders.tolist(), frame.shape[1]]
        for a, b in zip(edges, edges[1:]):
            if b - a < 2 or frame[4, b - 1] + k - frame[4, a] < span:
                continue
            fresh = np.append(True, (frame[4:, a + 1 : b] != frame[4:, a : b - 1]).any(axis=0))
            x, y = frame[4, a:b][fresh], frame[5, a:b][fresh]
            for path in chain_within(x, y, k, gap, cost):
                i, j = path[0], path[-1]
                if min(x[j] - x[i], y[j] - y[i]) + k >= span:
                    doc, part, ref, ref_part = frame[:4, a].tolist()
                    yield doc, part, int(x[i]), int(x[j]) + k, ref, ref_part, int(y[i]), int(y[j]) + k, x[path].astype("<i4").tobytes(), y[path].astype("<i4").tobytes()

    def batch_of(rows: list[tuple], number: int) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([pa.array(range(number, number + len(rows)), pa.int64()), *columns], [c.split()[0] for c in _CHAIN.split(", ")])

    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = found.select(*pair, "pos", "ref_pos").repartition(n, "doc_id", "part").sortWithinPartitions(*pair, "pos", "ref_pos")
    return cut_lineage(dealt.mapInArrow(run, _CHAIN), "chains")


def passages(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    similar: float = SIMILAR,
    k: int = K,
    run: int = RUN,
) -> DataFrame:
    """Passages of a document that stand, exactly or nearly, in an earlier place of the corpus.

    doc_id, part, start_word, n_words, ref_id, ref_start_word, ref_words, same_words, identity. Words are runs of
    characters other than ASCII white space, counted from 0, compared in ASCII lower case."""
    docs = _documents(df, id_col, text_col)
    linked = chains(matches(docs, k, run), k, least - 2 * (k + run))
    wide = lambda c, by: F.greatest(F.lit(0), F.col(c) + F.lit(by))
    ends = lambda side, doc, part, a, b: linked.select(
        F.col(doc).alias("doc_id"), F.col(part).alias("part"), F.col("chain"), F.lit(side).alias("side"), wide(a, -EXTEND).alias("low"), wide(b, EXTEND).alias("high")
    )
    wanted = ends(0, "doc_id", "part", "x_from", "x_to").unionAll(ends(1, "ref_id", "ref_part", "y_from", "y_to"))
    # documents that very many chains ask for are sent out several times; there are at most 10,000 of them
    total = 2 * linked.count()
    most = max(2_000, total // 10_000)
    copies = {(r["doc_id"], r["part"]): -(-r["n"] // most) for r in wanted.groupBy("doc_id", "part").agg(F.count("*").alias("n")).filter(F.col("n") > most).collect()}
    names = "doc_id long, part long, salt int, chain long, side int, low int, high int, text binary"

    def salted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            chain_ = batch.column(3).to_pylist()
            at, salt = [], []
            for i, key in enumerate(keys):
                n = copies.get(key, 1) if copies else 1
                for s in range(n) if chain_[i] is None else [chain_[i] % n]:
                    at.append(i), salt.append(s)
            rows = pa.array(at, pa.int64())
            columns = [c.take(rows) for c in batch.columns]
            columns[2] = pa.array(salt, pa.int32())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    none = lambda kind: F.lit(None).cast(kind)
    asked = wanted.select("doc_id", "part", F.lit(0).alias("salt"), "chain", "side", F.col("low").cast("int"), F.col("high").cast("int"), none("binary").alias("text"))
    held = docs.select("doc_id", "part", F.lit(0).alias("salt"), none("long").alias("chain"), F.lit(-1).alias("side"), none("int").alias("low"), none("int").alias("high"), "text")
    both = held.unionAll(asked)
    if copies:
        both = both.mapInArrow(salted, names)

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words, as 16-bit hashes, that each chain asks for; a document comes before its chains."""
        known, words, of = WordHash(), np.zeros(0, "<u2"), None
        for batch in batches:
            chain_, side, low, data = [], [], [], []
            columns = [c.to_pylist() for c in (batch.column(i) for i in range(7))]
            for i, (doc, part, _, number, which, a, b) in enumerate(zip(*columns)):
                if number is None:
                    if of != (doc, part):
                        pending, of = batch.column(7)[i].as_py(), (doc, part)
                        words = None
                    continue
                if words is None:
                    words = (word_hashes(pending, known) >> np.uint64(48)).astype("<u2")
                chain_.append(number), side.append(which), low.append(a), data.append(words[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(chain_, pa.int64()), pa.array(side, pa.int32()), pa.array(low, pa.int32()), pa.array(data, pa.binary())], ["chain", "side", "low", "words"]
            )

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "part", "salt", "side", "chain"]
    cut = both.repartition(n, "doc_id", "part", "salt").sortWithinPartitions(*order).mapInArrow(slices, "chain long, side int, low int, words binary")
    meta = [c.split()[0] for c in _CHAIN.split(", ")[1:]]
    kinds = dict(c.split() for c in _CHAIN.split(", "))
    parts = cut.select("chain", "side", "low", "words", *[none(kinds[c]).alias(c) for c in meta])
    heads = linked.select("chain", F.lit(-1).alias("side"), none("int").alias("low"), none("binary").alias("words"), *meta)
    met = parts.unionAll(heads).repartition(n, "chain").sortWithinPartitions("chain", "side")
    out = "doc_id long, part long, start_word int, n_words int, ref_id long, ref_start_word int, ref_words int, same_words int"

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in batch.to_pylist())
        done: list[tuple] = []
        for _, group in groupby(rows, key=lambda r: r["chain"]):
            head, x, y = group
            done.append(_align(head, x, y))
            if len(done) >= 5000:
                yield table(done)
                done = []
        yield table(done)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        fields = [f.split() for f in out.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if t == "long" else pa.int32()) for i, (_, t) in enumerate(fields)], [f for f, _ in fields])

    def _align(head: dict, x: dict, y: dict) -> tuple:
        a, b = np.frombuffer(x["words"], "<u2"), np.frombuffer(y["words"], "<u2")
        xs, ys = np.frombuffer(head["xs"], "<i4") - x["low"], np.frombuffer(head["ys"], "<i4") - y["low"]
        same, u, v = k, xs[0] + k, ys[0] + k
        for i, j in zip(xs[1:].tolist(), ys[1:].tolist()):
            same += align(a[u:i], b[v:j]) if i > u and j > v else 0
            same += k - max(0, u - i, v - j)
            u, v = i + k, j + k
        left, left_ref = reach(a[: xs[0]][::-1], b[: ys[0]][::-1])
        right, right_ref = reach(a[u:], b[v:])
        same += align(a[xs[0] - left : xs[0]], b[ys[0] - left_ref : ys[0]]) + align(a[u : u + right], b[v : v + right_ref])
        start, end = int(xs[0]) - left, int(u) + right
        ref, ref_end = int(ys[0]) - left_ref, int(v) + right_ref
        return head["doc_id"], head["part"], x["low"] + start, end - start, head["ref_id"], y["low"] + ref, ref_end - ref, same

    identity = F.col("same_words") / F.greatest("n_words", "ref_words")
    result = met.mapInArrow(aligned, out).withColumn("identity", identity)
    pieces = cut_lineage(result.filter(F.col("identity") >= similar).distinct(), "pieces")
    return pieces.filter(F.col("n_words") >= least).unionByName(_joined(pieces).filter(F.col("n_words") >= least))


def _joined(pieces: DataFrame) -> DataFrame:
    """Adjoining or overlapping pieces of one text as one passage, where it is longer than each of them.

    It names the place of its longest piece; its same words are those of the pieces, each counted for the words
    that no piece before it covers."""
    order = Window.partitionBy("doc_id", "part").orderBy("start_word", F.desc("n_words"), "ref_id", "ref_start_word")
    covered = F.max(F.col("start_word") + F.col("n_words")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = pieces.withColumn("end", F.col("start_word") + F.col("n_words")).withColumn("covered", covered)
    marked = marked.withColumn("span", F.count_if(F.col("covered").isNull() | (F.col("start_word") > F.col("covered"))).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    added = F.greatest(F.lit(0), F.col("end") - F.greatest("start_word", F.coalesce("covered", "start_word")))
    spans = marked.groupBy("doc_id", "part", "span").agg(
        F.min("start_word").alias("start_word"),
        (F.max("end") - F.min("start_word")).cast("int").alias("n_words"),
        F.max(F.struct("n_words", (-F.col("ref_id")).alias("first"), (-F.col("ref_start_word")).alias("at"), "ref_id", "ref_start_word", "ref_words")).alias("longest"),
        F.ceil(F.sum(added * F.col("identity")) - 1e-6).cast("int").alias("same_words"),
    )
    spans = spans.filter("n_words > longest.n_words").select("doc_id", "part", "start_word", "n_words", "longest.ref_id", "longest.ref_start_word", "longest.ref_words", "same_words")
    return spans.withColumn("identity", F.col("same_words") / F.greatest("n_words", "ref_words"))


def without(df: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with the spans (doc_id, part, start_word, n_words) taken out of its texts; all rows stay."""
    own = spans.groupBy("doc_id", "part").agg(F.collect_list(F.struct("start_word", "n_words")).alias("cut"))  # fewer than words
    part = F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).cast("long")
    # rows go as one column, so that no name of theirs can clash
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), part.alias("part"), F.col(text_col).alias("text"), F.struct(*[F.col(c) for c in df.columns]).alias("row"))
    joined = rows.join(own, ["doc_id", "part"], "left")
    cut = F.when(F.col("cut").isNotNull(), _remove(F.col("text"), F.col("cut"))).otherwise(F.col("text"))
    made = joined.select("row", cut.alias("text"))
    return made.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in df.columns])


@F.pandas_udf(T.StringType())
def _remove(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([remove(t, s) for t, s in zip(text, spans)], dtype=object)


def remove(text: str | None, spans) -> str | None:
    if text is None or spans is None:
        return text
    found = [m.span() for m in _WORDS(text)]
    keep, at = [], 0
    for start, n in sorted((s["start_word"], s["n_words"]) for s in spans):
        a, b = found[start][0], found[min(start + n, len(found)) - 1][1]
        if a > at:
            keep.append(text[at:a])
        at = max(at, b)
    keep.append(text[at:])
    return " ".join(x for x in (k.strip() for k in keep) if x)
