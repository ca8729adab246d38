"""Spelling variants: words of a corpus one insertion, deletion or replacement apart, grouped under the
spelling that is clearly more frequent.

A word one error away from another still holds the other's first or its second half unchanged. So two search
schemes find all of them: the first half exactly and the second with one error, going right, and the second
half exactly and the first with one error, going left. Each runs on an FM-index, one of the words and one of
the words read backwards, over a text in which every word is delimited. A search begins at a
delimiter, narrows the interval of suffix ranks over the exact half, branches once over the other half
and ends at the next delimiter. The rank it ends on is the found word's place in the sorted vocabulary. As
a half ends at a delimiter, each scheme goes one way only, and its interval in the other index is not needed.

The vocabulary is dealt into shards by length and the letters that any word one error away must share on the
exact side; words visit the shards of the three lengths next to theirs. A shard's index and a block of visits
are bounded: letters shared by more words than that are split further, each part searched by all who
share them. Nothing is collected or broadcast but what Spark finds small.

Defined cases: null and empty texts have no words; rows count as often as they are repeated; in rows with a null
id no letter is deleted; only runs of letters are looked at, extra columns are not; ties of count go to the
smaller word in code-point order; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laminae.llm.columns import texts
from laminae.session import cut_lineage

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LETTERS, MIN_COUNT, MARGIN = 5, 3, 2
SHARD, VISITS = 16_384, 65_536
HELD = 200_000  # distinct words that a task counts before it passes them on
Edit = Callable[[int, Counter], Counter]


class Index:
    """FM-index of distinct words, each between delimiters. LF-steps of many intervals are one search in a sorted
    array of (symbol, place in the transform)."""

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        points = np.frombuffer("\0".join(["", *self.words]).encode("utf-32-le"), np.uint32)
        self.symbols, text = np.unique(points, return_inverse=True)  # the delimiter is symbol 0
        n = self.n = len(text)
        rank, known = text, 1
        while True:  # prefix doubling; words differ, so all rotations do
            key = rank * n + np.roll(rank, -known)
            order = np.argsort(key, kind="stable")
            key = key[order]
            fresh = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            if fresh[-1] == n - 1:
                break
            known *= 2
        self.transform = text[order - 1]
        self.steps = np.sort(self.transform * n + np.arange(n))

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of suffixes that begin with the symbol and go on with one of the given interval."""
        at = symbol * self.n
        return np.searchsorted(self.steps, at + low), np.searchsorted(self.steps, at + high)

    def before(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which interval (its number) has which symbols, but the delimiter, before its suffixes."""
        size, sigma = high - low, len(self.symbols)
        wide, narrow = np.flatnonzero(size > 2 * sigma), np.flatnonzero(size <= 2 * sigma)
        each = np.repeat(narrow, size[narrow])
        place = np.arange(len(each)) - np.repeat(np.cumsum(size[narrow]) - size[narrow], size[narrow]) + low[each]
        seen = np.unique(each * sigma + self.transform[place])
        every = (wide[:, None] * sigma + np.arange(sigma)).ravel()
        seen = np.concatenate([seen, every])
        owner, symbol = seen // sigma, seen % sigma
        kept = symbol > 0
        return owner[kept], symbol[kept]

    def one_error(self, patterns: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, word) numbers of all words that end with the pattern's last letters, exact of them, and
        differ from it before these by one letter inserted, deleted or replaced. Each pair comes once."""
        long = np.fromiter(map(len, patterns), np.int64, len(patterns))
        points = np.frombuffer("".join(patterns).encode("utf-32-le"), np.uint32)
        code = np.searchsorted(self.symbols, points)
        code[self.symbols[np.minimum(code, len(self.symbols) - 1)] != points] = -1
        base = np.cumsum(long) - long
        pattern, left = np.arange(len(patterns)), long.copy()
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.words), np.int64)

        def read(which: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Which of the states go on with the pattern's next letter, and their new intervals."""
            symbol = code[base[pattern[which]] + left[which] - 1]
            known = symbol >= 0
            which, (low, high) = which[known], self.step(symbol[known], low[which[known]], high[which[known]])
            some = high > low
            return which[some], low[some], high[some]

        closing = np.flatnonzero(exact > 0)
        alive = exact <= 0
        while len(closing):  # the exact half
            closing, lo, hi = read(closing, low, high)
            low[closing], high[closing] = lo, hi
            left[closing] -= 1
            done = long[closing] - left[closing] >= exact[closing]
            alive[closing[done]] = True
            closing = closing[~done]
        pattern, left, low, high = pattern[alive], left[alive], low[alive], high[alive]
        wrong = np.zeros(len(pattern), bool)
        found: list[np.ndarray] = []
        while len(pattern):
            ending = np.flatnonzero(wrong & (left == 0))
            lo, hi = self.step(np.zeros(len(ending), np.int64), low[ending], high[ending])
            found.append(np.stack([pattern[ending], lo])[:, hi > lo])
            going, lo, hi = read(np.flatnonzero(left > 0), low, high)
            parts = [(pattern[going], left[going] - 1, lo, hi, wrong[going])]
            right = np.flatnonzero(~wrong)
            owner, symbol = self.before(low[right], high[right])
            owner = right[owner]
            lo, hi = self.step(symbol, low[owner], high[owner])
            some = hi > lo
            owner, symbol, lo, hi = owner[some], symbol[some], lo[some], hi[some]
            error = np.ones(len(owner), bool)
            parts.append((pattern[owner], left[owner], lo, hi, error))  # a letter more
            other = left[owner] > 0
            other[other] = code[base[pattern[owner[other]]] + left[owner[other]] - 1] != symbol[other]
            parts.append((pattern[owner[other]], left[owner[other]] - 1, lo[other], hi[other], error[other]))
            less = right[left[right] > 0]
            parts.append((pattern[less], left[less] - 1, low[less], high[less], np.ones(len(less), bool)))
            pattern, left, low, high, wrong = map(np.concatenate, zip(*parts))
            # the same error can be made at each of equal letters in a row: one state is enough
            key = np.stack([pattern, left, low, high, wrong])
            order = np.lexsort(key)
            key = key[:, order]
            keep = order[np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])] if len(order) else order
            pattern, left, low, high, wrong = pattern[keep], left[keep], low[keep], high[keep], wrong[keep]
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        pairs = np.unique(pairs[0] * len(self.words) + pairs[1])
        return pairs // len(self.words), pairs % len(self.words)


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 1, min_count: int = 1, edit: Edit | None = None) -> DataFrame:
    """word, n: how often each run of letters, A to Z lower-cased, occurs. edit, if given, gets a row's id and its
    counted words and returns the counts to use."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed_on() -> pa.RecordBatch:
            kept = [(w, n) for w, n in held.items() if len(w) >= min_letters]
            held.clear()
            return pa.RecordBatch.from_pydict({"word": pa.array([w for w, _ in kept], pa.string()), "n": pa.array([n for _, n in kept], pa.int64())})

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = LETTERS.findall(text.as_py().lower().decode())
                if edit:
                    words = edit(i, Counter(words))
                held.update(words)
            if len(held) > HELD:
                yield passed_on()
        yield passed_on()

    counted = texts(df, id_col, text_col).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def _letters(word: str, length: str, shift: int) -> F.Column:
    """The letters at the end of a word that it must share with any word of that length one error away."""
    return F.expr(f"right({word}, cast(floor((length({length}) + {shift} - 1) / 2) as int))")


def _dealt(words: DataFrame, shard: int, visits: int) -> tuple[DataFrame, int]:
    """Rows of kind 0 (words to index) and 1 (words to look up) with the group in which they meet, and how many
    partitions to deal the groups to."""
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.reverse("word").alias("turned")), F.struct(F.lit(1).alias("side"), F.col("word").alias("turned"))))
    turned = words.select("word", "n", sides.alias("s")).select("s.side", F.col("s.turned").alias("word"), "n")
    shared = lambda k: F.struct((F.length("word") + k).alias("length"), _letters("word", "word", k).alias("letters"))
    stored = turned.select("side", shared(0).alias("key"), "word", "n", F.lit(0).alias("kind"))
    asked = turned.select("side", F.explode(F.array(shared(-1), shared(0), shared(1))).alias("key"), "word", "n", F.lit(1).alias("kind"))
    both = stored.unionAll(asked)
    sizes = both.groupBy("side", "key").agg(F.sum(1 - F.col("kind")).alias("stored"), F.sum("kind").alias("asked"))
    sizes = cut_lineage(sizes.filter("stored > 0"), "letters")
    shards = max(1, -(-words.count() // shard))
    parts, blocks = (F.ceil(F.col(c) / limit).cast("int").alias(to) for c, limit, to in (("stored", shard, "parts"), ("asked", visits, "blocks")))
    sized = both.join(sizes.select("side", "key", parts, blocks), ["side", "key"])
    # a stored word lies in one part and meets every block of visits; a visit lies in one block and meets every part
    own = lambda n: F.array(F.pmod(F.xxhash64("word"), F.col(n)).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    stores = F.col("kind") == 0
    met = sized.withColumn("part", F.explode(F.when(stores, own("parts")).otherwise(every("parts"))))
    met = met.withColumn("block", F.explode(F.when(stores, every("blocks")).otherwise(own("blocks"))))
    usual = (F.col("parts") == 1) & (F.col("blocks") == 1)
    split = F.xxhash64("side", "key", "part", "block").bitwiseOR(F.lit(1 << 62))  # above all usual numbers
    group = F.when(usual, F.pmod(F.xxhash64("side", "key"), F.lit(shards))).otherwise(split)
    spread = max(2 * shards, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return met.select("side", group.alias("group"), "kind", "word", "n"), spread


def neighbours(words: DataFrame, shard: int = SHARD, visits: int = VISITS) -> DataFrame:
    """word, n_near, best (a struct of n and word: the nearest ones' most frequent, ties to the smaller) for each
    word with others one error away. words: distinct, with counts n."""
    met, spread = _dealt(words, shard, visits)
    rows = met.repartition(spread, "side", "group").sortWithinPartitions("side", "group", "kind", "word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, stored, index, last = None, {}, None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                if hi == lo:
                    continue
                part, (side, number, kind) = batch.slice(lo, hi - lo), keys[:, lo].tolist()
                if (side, number) != group:
                    group, stored, index, last = (side, number), {}, None, None
                words = part.column(3).to_pylist()
                if kind == 0:
                    stored.update(zip(words, part.column(4).to_pylist()))
                elif stored:
                    index = index or Index(list(stored))
                    # a word that visits a shard for two lengths comes twice in a row
                    asked = [w for w, before in zip(words, [last, *words]) if w != before]
                    last = words[-1]
                    if asked:
                        yield answers(index, stored, asked, backwards=side == 0)

    found = rows.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("best")
    total = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return total.select("word", "n_near", F.struct((-F.col("best.less")).alias("n"), "best.word").alias("best"))


def answers(index: Index, count: dict[str, int], asked: list[str], backwards: bool) -> pa.RecordBatch:
    """One row for each asked word that has words near it in this index. Words read backwards have their first
    half at the end; read forwards, pairs that share the first half too are left to the other scheme."""
    exact = np.array([(len(q) + backwards) // 2 for q in asked], np.int64)
    n_near: Counter[int] = Counter()
    best: dict[int, tuple[int, str]] = {}
    for q, w in zip(*(x.tolist() for x in index.one_error(asked, exact))):
        word, half = index.words[w], (len(asked[q]) + 1) // 2
        if not backwards and word[:half] == asked[q][:half]:
            continue
        n_near[q] += 1
        own = (-count[word], word[::-1] if backwards else word)
        best[q] = min(best.get(q, own), own)
    words = [asked[q][::-1] if backwards else asked[q] for q in best]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(words, pa.string()),
            pa.array([n_near[q] for q in best], pa.int64()),
            pa.array([-n for n, _ in best.values()], pa.int64()),
            pa.array([w for _, w in best.values()], pa.string()),
        ],
        ["word", "n_near", "best_n", "best"],
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that is reached from each by its form (null: itself). Every round follows twice
    as many steps as the one before; counts at least double with each form, so there are few rounds."""
    reached = cut_lineage(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        further = reached.filter("word <> root").select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = reached.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = cut_lineage(moved, "roots")
        reached = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return reached


def variants(words: DataFrame, margin: int = MARGIN, shard: int = SHARD, visits: int = VISITS) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word (distinct, with counts n). The form of a word is the most
    frequent one near it, if that is margin times as frequent, else null."""
    words = cut_lineage(words.select("word", "n"), "words")
    near = neighbours(words, shard, visits)
    better = F.col("best.n") >= margin * F.col("n")
    joined = words.join(near, "word", "left").select(
        "word",
        F.when(better, F.col("best.word")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("best.n")).alias("form_n"),
    )
    joined = cut_lineage(joined, "forms")
    return joined.join(roots(joined), "word").select("word", "form", "root", "n", "n_near", "form_n")


def drop_letter(doc_id: int | None, words: Counter, every: int = 97) -> Counter:
    """Counts of one row's words after a letter is deleted from those whose checksum with the id says so."""
    if doc_id is None:
        return words
    start = zlib.crc32(f"{doc_id}:".encode())
    changed: Counter[str] = Counter()
    for word, n in words.items():
        h = zlib.crc32(word.encode(), start)
        if h % every == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        changed[word] += n
    return changed
