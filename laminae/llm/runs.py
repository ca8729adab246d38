"""Maximal periodic runs of words, found by uniting suffix classes by decreasing common prefix.

The words of a batch of texts are numbered, each text followed by ends that equal nothing. Only places
whose first few words stand elsewhere in their text can begin a run that is asked for; these are sorted by
prefix doubling, and neighbours in that order get the length of their common prefix. Kruskal's way
through these links, longest first, unites classes of suffixes that share ever shorter prefixes. Each class
keeps its places in order. A union makes places of the two classes neighbours that share exactly the
link's length; if their distance is within it, the words from the first one on repeat with that distance,
and the run begins there unless the word before keeps the period too. Of a run, the first place and the one a
period later are such a pair, as a primitive word does not occur inside its own square, so every run is
seeded once, with its smallest period and whole length.

A text is worked on as a whole by one task; batches are bounded by size, so memory is that of the longest
text (about ten times its bytes). Uniting moves places from the smaller class to the larger one, so each place
moves a logarithmic number of times.

Defined cases: a null or empty text, or one of white space, has no words and no runs; every row, repeated
ones too, gets a row of its own; a null id stays null; extra columns are not looked at; runs of equal start
come in order of their period; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from laminae.llm.columns import texts

MIN_LENGTH, MIN_EXPONENT = 6, 4
_MIX, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)
Run = tuple[int, int, int]


def shared_words(min_length: int, min_exponent: int) -> int:
    """The fewest words that the first two places of a run asked for, a period apart, have in common."""
    return min(max(min_length, min_exponent * q) - q for q in range(1, min_length + 1))


def repeated(seq: np.ndarray, text: np.ndarray, width: int) -> np.ndarray:
    """Places whose next words, width of them, may stand elsewhere in the same text. Never misses one."""
    n = len(seq) - width + 1
    key = text[:n].astype(np.uint64) * _MIX
    for j in range(width):
        key = key * _STEP + seq[j : j + n].astype(np.uint64)
    key = (key ^ (key >> np.uint64(29))) * _MIX
    whole = np.flatnonzero((seq[:n] >= 0) & (seq[width - 1 : width - 1 + n] >= 0))
    order = np.argsort(key[whole])
    key = key[whole][order]
    same = key[1:] == key[:-1]
    hit = np.zeros(len(whole), bool)
    hit[1:] |= same
    hit[:-1] |= same
    return np.sort(whole[order[hit]])


def suffix_links(seq: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and their predecessors in suffix order, where these share at least width words of one text.
    seq ends each text by width negative entries."""
    active = repeated(seq, text, width)
    places = np.union1d(active, active + width)
    columns = [seq[places + j] for j in range(width - 1, -1, -1)] + [text[places]]
    order = np.lexsort(columns)
    sa = places[order]
    fresh = np.ones(len(sa), bool)  # where a class of equal prefixes begins
    if len(sa):
        fresh[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    began = np.maximum.accumulate(np.where(fresh, np.arange(len(sa)), 0))
    first = ~fresh
    rank = np.full(len(seq), -1, np.int64)
    rank[sa] = began
    known = width
    while True:
        open_ = np.flatnonzero(~(fresh & np.append(fresh[1:], True)))
        if not len(open_):
            break
        at = sa[open_]
        head, tail = rank[at], rank[at + known]
        order = np.lexsort((tail, head))
        sa[open_] = at[order]
        head, tail = head[order], tail[order]
        fresh[open_[1:]] |= (head[1:] == head[:-1]) & (tail[1:] != tail[:-1])
        began = np.maximum.accumulate(np.where(fresh, np.arange(len(sa)), 0))
        rank[sa] = began
        known *= 2
    here = np.flatnonzero(first)
    at, before = sa[here], sa[here - 1]
    order = np.argsort(at)
    return at[order], before[order]


def common_prefixes(seq: list[int], at: list[int], before: list[int], width: int) -> list[int]:
    """Words that each place shares with its predecessor. The next place shares at most one fewer, so all
    texts are read once."""
    found, shared, last = [], 0, -2
    for i, j in zip(at, before):
        shared = shared - 1 if i == last + 1 and shared > width else width
        while seq[i + shared] == seq[j + shared]:
            shared += 1
        found.append(shared)
        last = i
    return found


def unite(links: Iterator[tuple[int, int, int]], places: list[int]) -> Iterator[tuple[int, int, int]]:
    """From links (place, place, shared words) in decreasing order: (x, y, shared) for places x < y that the
    union of their classes made neighbours."""
    home = {p: [p] for p in places}  # the class of each place, its places in order
    for i, j, shared in links:
        large, small = home[i], home[j]
        if len(large) < len(small):
            large, small = small, large
        slots = [bisect_left(large, x) for x in small]
        end = len(large)
        before = -1
        for k, x in enumerate(small):
            slot = slots[k]
            if slot and slot != before:
                yield large[slot - 1], x, shared
            if slot < end and (k + 1 == len(small) or slots[k + 1] != slot):
                yield x, large[slot], shared
            before = slot
            home[x] = large
        if len(small) * 32 < end:
            for slot, x in zip(reversed(slots), reversed(small)):
                large.insert(slot, x)
        else:
            large += small
            large.sort()  # two ascending runs: one merge


def find_runs(docs: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[Run]]:
    """Of each text's words: (start, length, period) of its runs of at least min_length words and min_exponent
    periods (2 or more), by start, then period."""
    width = shared_words(min_length, min_exponent)
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    end = [-1] * width
    parts = chain.from_iterable(chain(map(number.__getitem__, words), end) for words in docs)
    sizes = np.fromiter((len(words) + width for words in docs), np.int64, len(docs))
    seq = np.fromiter(chain([-1], parts), np.int64, int(sizes.sum()) + 1)
    starts = np.cumsum(sizes) - sizes + 1
    text = np.concatenate([[-1], np.repeat(np.arange(len(docs)), sizes)])
    found: list[list[Run]] = [[] for _ in docs]
    at, before = suffix_links(seq, text, width)
    if not len(at):
        return found
    words = seq.tolist()
    shared = np.array(common_prefixes(words, at.tolist(), before.tolist(), width))
    order = np.argsort(-shared, kind="stable")
    links = zip(at[order].tolist(), before[order].tolist(), shared[order].tolist())
    runs = []
    for x, y, same in unite(links, np.union1d(at, before).tolist()):
        period = y - x
        if same >= (min_exponent - 1) * period and same + period >= min_length and words[x - 1] != words[y - 1]:
            runs.append((x, same + period, period))
    runs.sort(key=lambda r: (r[0], r[2]))
    owner = text[[r[0] for r in runs]].tolist() if runs else []
    for d, (x, length, period) in zip(owner, runs):
        found[d].append((x - int(starts[d]), length, period))
    return found


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    step = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _runs_column(found: list[list[Run]]) -> pa.ListArray:
    flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
    ends = np.concatenate([[0], np.cumsum([len(runs) for runs in found])]).astype(np.int32)
    rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))
    return pa.ListArray.from_arrays(pa.array(ends), rows)


def periodic_runs(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """doc_id, n_words, runs (an array of start, length and period, by start, then period) and collapsed, the
    text of the words that no run repeats, joined by one space, for each row. Words are what ASCII white
    space separates. edit, if given, gets the id and words of each text and returns the words to look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = [t.as_py().split() for t in batch.column(1)]
            if edit:
                docs = [edit(i, words) for i, words in zip(batch.column(0).to_pylist(), docs)]
            found = find_runs(docs, min_length, min_exponent)
            kept = pa.array([b" ".join(collapse(words, runs)) for words, runs in zip(docs, found)], pa.binary()).cast(pa.string())
            sizes = pa.array([len(words) for words in docs], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, _runs_column(found), kept], ["doc_id", "n_words", "runs", "collapsed"])

    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return texts(df, id_col, text_col).mapInArrow(run, schema)
