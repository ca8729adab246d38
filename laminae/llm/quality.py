"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model.

The model learns the word trigrams of trusted text, all labelled rows outside the fold that sets the thresholds. Its count
tables are sharded by context, where each context's total and discounts are found in place; with the
values of their shorter forms and contexts they meet in joins by hashed n-gram.

An interpolated model is a sum over n-grams once it is written with differences: a text's log
probability is what its words would get if all were unknown, plus, for each of its n-grams that the
model holds, that n-gram's value (its own log probability less that of its shorter form, plus
the weight it passes on as a context). So documents need nothing but a join of their n-grams with the
model's values and a sum. The values of n-grams seen at least twice, and then of
words and pairs seen once, about `shared` at most, go to every task. The others stay sharded and are joined; a bit table of bounded size tells the tasks which of a
document's n-grams may be among them, so many n-grams are never shuffled. Both joins of all n-grams, that of triples with the pairs they
end in and that of documents with values, go in up to `ROUNDS` rounds, each over one part of the hashes and with its
shuffle files deleted at its end: disk holds the tables and one part's shuffle, never all n-grams of all documents.

The threshold of a language is a quantile of the perplexities of trusted rows that the model did not learn
from, each drawn towards the language's median as if by `prior` more tokens, so that a few rare words
do not condemn a short text, and `margin` bits are added, so that the few trusted rows of a small table do not
set it too low. A language without trusted rows among these has no threshold and is kept, as the model may
know none of its words.

Defined cases: null and empty texts have one token, the end; null languages form one language; labels
that are null or not 1 are not trusted; a null id is never learned from; without trusted rows nothing is
rejected; repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laminae.llm import bits
from laminae.llm.columns import held_out, texts
from laminae.session import cut_lineage, drop_scratch

SHARED, QUANTILE, PRIOR, MARGIN, FOLDS = 1_500_000, 0.998, 40.0, 0.5, 5
ROUNDS, ROUND_ROWS = 4, 1_000_000  # at most so many rounds; with no more rows than that, fewer do
HELD = 1_500_000  # words of trusted texts that a task counts at once
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    of = np.full(n, base, np.uint64)
    of[0] = 1
    return np.cumprod(of)


_IN_WORD = np.array([i not in b" \t\n\r\x0b\x0c" for i in range(256)])  # as bytes.split parts words
_OF_BYTE = np.random.default_rng(3).integers(0, 2**64, 256, np.uint64)
_BASE, _BLOCK, _PIECE = 0xD1342543DE82EF95, 2048, 1 << 16
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS, _BACK = _powers(_BASE, _BLOCK), _powers(_INVERSE, _BLOCK)
_START, _END = 1, 2  # hashes of the marks at the start and the end
_START_PAIR = int(np.array([(32 * int(_MIX)) % 2**64], np.uint64).view(np.int64)[0])  # of two starts


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words that lie in data: the sum of a random number for each byte times a power of _BASE for its
    place in the word, mixed. Sums over all bytes so far, one subtraction and one inverse power for each word give it."""
    out = np.empty(len(starts), np.uint64)
    pieces = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(data), _PIECE)), len(starts)))
    for i, j in zip(pieces[:-1], pieces[1:]):
        at, end = starts[i:j] - starts[i], ends[i:j] - starts[i]
        n = int(end[-1])
        blocks = -(-n // _BLOCK)
        sums = np.zeros(blocks * _BLOCK + 1, np.uint64)
        np.take(_OF_BYTE, data[starts[i] : ends[j - 1]], out=sums[1 : n + 1], mode="clip")
        places = sums[1:].reshape(blocks, _BLOCK)
        places *= _POWERS
        places *= _powers(pow(_BASE, _BLOCK, 2**64), blocks)[:, None]
        np.cumsum(sums, out=sums)
        back = _BACK[at & (_BLOCK - 1)] * _powers(pow(_INVERSE, _BLOCK, 2**64), blocks)[at // _BLOCK]
        out[i:j] = (sums[end] - sums[at]) * back
    out = (out ^ (out >> np.uint64(32))) * _MIX
    return out ^ (out >> np.uint64(29))


def batch_ngrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashed words of a batch of texts, each text after two starts and before its end, in one row; the places of the
    n-grams' last words in it, and the number of the text of each place."""
    texts = [text.as_py() for text in texts]
    data = np.frombuffer(b" ".join(texts), np.uint8)
    edges = np.flatnonzero(np.diff(_IN_WORD[data].astype(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    bounds = np.cumsum([0, *(len(text) + 1 for text in texts)])
    sizes = np.diff(np.searchsorted(starts, bounds))
    w = np.full(len(starts) + 3 * len(texts), _START, np.uint64)
    of = np.repeat(np.arange(len(texts)), sizes + 1)
    at = np.arange(len(of)) + 2 * of + 2
    inner = np.ones(len(of), bool)
    inner[np.cumsum(sizes + 1) - 1] = False
    w[at[inner]] = word_hashes(data, starts, ends)
    w[at[~inner]] = _END
    return w, at, of


def trusted_ngrams(trusted: DataFrame) -> DataFrame:
    """Triples of trusted texts with their counts: left pair, middle and last word, sharded by left pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = [], 0

        def flush() -> pa.RecordBatch:
            left, middle, word = (np.concatenate(x) for x in zip(*seen))
            _, first, n = np.unique((left * np.uint64(37) + word) * _MIX, return_index=True, return_counts=True)
            seen.clear()
            return pa.RecordBatch.from_arrays([*(pa.array(x[first].view(np.int64)) for x in (left, middle, word)), pa.array(n)], ["left", "middle", "word", "n"])

        for batch in batches:
            w, at, _ = batch_ngrams(batch.column(1))
            if len(at):
                seen.append(((w[at - 2] * np.uint64(31) + w[at - 1]) * _MIX, w[at - 1], w[at]))
                held += len(at)
            if held > HELD:
                yield flush()
                held = 0
        if seen:
            yield flush()

    made = trusted.mapInArrow(run, "left long, middle long, word long, n long")
    return made.repartition("left").groupBy("left", "middle", "word").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame, n: str) -> list[float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more."""
    of = counts.agg(*[F.count_if(F.col(n) == i).alias(f"n{i}") for i in range(1, 5)]).first()
    n1, n2, n3, n4 = (float(x) for x in of)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.1), i - 0.05) for i, d in enumerate(raw, 1)]


def _discounted(n: str, d: list[float]) -> Column:
    return F.col(n) - F.when(F.col(n) == 1, d[0]).when(F.col(n) == 2, d[1]).otherwise(d[2])


def _in_context(counts: DataFrame, context: str) -> DataFrame:
    """Adds the context's total, its numbers of counts of 1, 2 and more, and whether a row is its first.

    counts are sharded by the context already, so this shuffles nothing."""
    own = Window.partitionBy(context)
    k1, k2, k3 = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2), F.count_if(F.col("n") > 2)
    return counts.withColumns(
        {
            "all": F.sum("n").over(own),
            "k1": k1.over(own).cast("int"),
            "k2": k2.over(own).cast("int"),
            "k3": k3.over(own).cast("int"),
            "head": F.row_number().over(own.orderBy("word")) == 1,
        }
    )


def _pass_on(d: list[float]) -> Column:
    """The share of a context that its discounts free."""
    return sum(F.col(f"k{i}") * x for i, x in enumerate(d, 1)) / F.col("all")


def _hashed(df: DataFrame, drop: list[str], **hashes: tuple[str, int]) -> DataFrame:
    """Adds hashes of a context and the last word, as ngrams makes them, and leaves out columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = batch.column("word").to_numpy().view(np.uint64)
            more = [(batch.column(c).to_numpy().view(np.uint64) * np.uint64(k) + word) * _MIX for c, k in hashes.values()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(x.view(np.int64)) for x in more)], [*kept, *hashes])

    kept = [c for c in df.columns if c not in drop]
    types = dict(df.dtypes)
    return df.mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in kept), *(f"{h} long" for h in hashes)]))


def _rounds(rows: int) -> int:
    """A power of two, at most ROUNDS, so that the parts of any number of rounds are unions of those of ROUNDS."""
    rounds = 1
    while rounds < ROUNDS and rounds * ROUND_ROWS < rows:
        rounds *= 2
    return rounds


def train(trusted: DataFrame) -> tuple[DataFrame, float, float]:
    """Values of all n-grams (gram, value, n, size), an unknown word's log2 probability and a start's value.

    trusted holds doc_id and text as bytes. Shards meet by n-gram and by context."""
    three = cut_lineage(_in_context(trusted_ngrams(trusted), "left"), "triples")
    # pairs and words count their distinct left neighbours; a pair at a text's start has only one, so it keeps its count
    pair = F.when(F.col("middle") == _START, F.sum("n")).otherwise(F.count("*"))
    two = three.select("middle", "word", "n").repartition("middle").groupBy("middle", "word").agg(pair.alias("n"), F.sum("n").alias("seen"))
    two = cut_lineage(_in_context(two, "middle"), "pairs")
    one = cut_lineage(two.groupBy("word").agg(F.count("*").alias("n"), F.sum("seen").alias("seen")), "words")
    d3, d2, d1 = discounts(three, "n"), discounts(two, "n"), discounts(one, "n")
    total = one.agg(F.sum("n").alias("all"), F.count("*").alias("kinds"), F.sum(F.col("n") - _discounted("n", d1)).alias("freed")).first()
    if not total["all"]:
        return two.select(F.col("word").alias("gram"), F.lit(0.0).cast("float").alias("value"), F.col("n"), F.lit(1).alias("size")).limit(0), 0.0, 0.0
    unknown = total["freed"] / total["all"] / (total["kinds"] + 1)
    p1 = one.select("word", (_discounted("n", d1) / total["all"] + unknown).alias("p1"), F.col("seen").alias("seen1"))
    log2, on, real = F.log2, F.coalesce("on", F.lit(0.0)), lambda c: c.cast("float")
    on2 = two.filter("head").select(F.col("middle").alias("context"), log2(_pass_on(d2)).alias("on"))
    on3 = three.filter("head").select(F.col("left").alias("context"), log2(_pass_on(d3)).alias("on"))
    # what a text's start passes on: as a context by itself, and doubled as a pair
    starts = on2.filter(F.col("context") == _START).unionAll(on3.filter(F.col("context") == _START_PAIR)).agg(F.sum("on")).first()[0]
    words = p1.join(on2, F.col("word") == F.col("context"), "left").select(
        F.col("word").alias("gram"), real(log2("p1") - log2(F.lit(unknown)) + on).alias("value"), F.col("seen1").alias("n"), F.lit(1).alias("size")
    )
    words = cut_lineage(words, "word-values")
    # each table is deleted when the last one that needs it is written: of the counts, little more than the triples is held at once
    p2 = two.join(p1, "word").select(
        "middle", "word", "seen", "p1", _pass_on(d2).alias("pass_on"), (_discounted("n", d2) / F.col("all") + _pass_on(d2) * F.col("p1")).alias("p2")
    )
    part = F.pmod(F.xxhash64("middle", "word"), F.lit(ROUNDS)).cast("int").alias("part")
    p2 = p2.select("middle", "word", "seen", part, real(F.col("p2")).alias("p2"), real(log2("p2") - log2("pass_on") - log2("p1")).alias("value"))
    p2 = cut_lineage(_hashed(p2, ["middle", "word"], right=("middle", 31)), "pair-shares")
    drop_scratch(two, one)
    pairs = p2.join(on3, F.col("right") == F.col("context"), "left").select("right", "seen", "part", "p2", real(F.col("value") + on).alias("value"))
    pairs = cut_lineage(pairs, "pair-values")
    drop_scratch(p2)
    whole = F.col("pass_on") * F.col("p2").cast("double")
    rounds, triples = _rounds(three.count()), []
    for r in range(rounds):
        # a pair and the triples that end in it are in one part
        own = three.filter(F.pmod(F.xxhash64("middle", "word"), F.lit(rounds)) == r).select("left", "middle", "word", "n", real(_pass_on(d3)).alias("pass_on"), real(_discounted("n", d3) / F.col("all")).alias("share"))
        p3 = _hashed(own, ["left", "middle", "word"], triple=("left", 37), right=("middle", 31)).join(pairs.filter(F.col("part") % rounds == r).select("right", "p2"), "right")
        triples.append(cut_lineage(p3.select(F.col("triple").alias("gram"), real(log2(F.col("share") + whole) - log2(whole)).alias("value"), "n"), "triple-values"))
    triples = reduce(DataFrame.unionAll, triples)
    drop_scratch(three)
    values = words.unionAll(pairs.select(F.col("right").alias("gram"), "value", F.col("seen").alias("n"), F.lit(2)))
    return values.unionAll(triples.select("gram", "value", "n", F.lit(3))), float(np.log2(unknown)), starts


def perplexities(df: DataFrame, model: tuple[DataFrame, float, float], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", shared: int = SHARED) -> DataFrame:
    """doc_id, row (a key of id, text and language), lang, n_tokens and perplexity, one row for each distinct key."""
    values, unknown, start = model
    spark = df.sparkSession
    # frequent n-grams first, then words and pairs seen once, up to shared; of a class that does not fit, a range of hashes
    room, whole, part = shared, None, None
    sizes = values.groupBy("n", "size").count().collect()  # few different counts
    for r in sorted((r for r in sizes if r["n"] > 1 or r["size"] < 3), key=lambda r: (-r["n"], r["size"])):
        if r["count"] > room:
            part = r["n"], r["size"], room * 256 // r["count"]
            break
        room, whole = room - r["count"], (r["n"], r["size"])
    n, size, is_shared = F.col("n"), F.col("size"), F.lit(False)
    if whole:
        is_shared = (n > whole[0]) | ((n == whole[0]) & (size <= whole[1]))
    if part:
        is_shared |= (n == part[0]) & (size == part[1]) & (F.pmod("gram", F.lit(256)) < part[2])
    table = values.filter(is_shared).select("gram", "value").toArrow()
    grams, worth = table["gram"].to_numpy().view(np.uint64), table["value"].to_numpy().astype(np.float32)
    order = np.argsort(grams)
    grams, worth = grams[order], worth[order]
    rounds = _rounds(sum(r["count"] for r in sizes) - len(grams))
    keyed = texts(df, id_col, text_col, row=F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.col(lang_col).cast("string")), lang=F.coalesce(F.col(lang_col).cast("string"), F.lit("")))
    sums = []
    for r in range(rounds):
        rare = values.filter(~is_shared & (F.pmod("gram", F.lit(rounds)) == r)).select("gram", "value")
        own = grams % np.uint64(rounds) == r
        flags = bits.build(rare, "gram", bits.BITS - rounds.bit_length() + 1)
        sent = spark.sparkContext.broadcast((grams[own].tobytes(), worth[own].tobytes(), flags))
        sums.append(cut_lineage(_one_round(keyed, rare, sent, rounds, r, start, unknown), "sums"))
        sent.destroy()
    summed = reduce(DataFrame.unionAll, sums).groupBy("doc_id", "row").agg(
        F.first("lang", ignorenulls=True).alias("lang"), F.sum("copies").alias("copies"), F.sum("n").alias("n"), F.sum("logs").alias("logs")
    )
    out = summed.select("doc_id", "row", "lang", "copies", (F.col("n") / F.col("copies")).cast("long").alias("n_tokens"), F.pow(F.lit(2.0), -F.col("logs") / F.col("n")).alias("perplexity"))
    out = cut_lineage(out, "perplexities")
    drop_scratch(*sums)
    return out


def _one_round(keyed: DataFrame, rare: DataFrame, sent: Broadcast, rounds: int, r: int, start: float, unknown: float) -> DataFrame:
    """What the n-grams of one part of the hashes add to each text. The first round also counts texts and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, value, flags = (np.frombuffer(b, k) for b, k in zip(sent.value, (np.uint64, np.float32, np.uint64)))
        shift, first = directory(keys)
        mask = np.uint64(rounds - 1)
        for batch in batches:
            texts_ = len(batch)
            w, at, of = batch_ngrams(batch.column(1))
            tokens = np.bincount(of, minlength=texts_)
            logs = start + unknown * tokens if r == 0 else np.zeros(texts_)
            pair = (w[:-1] * np.uint64(31) + w[1:]) * _MIX
            triple = (pair[:-1] * np.uint64(37) + w[2:]) * _MIX
            found, owner = [np.zeros(texts_, np.uint64)], [np.arange(texts_)]  # the rows of the texts themselves
            for grams in (w[at], pair[at - 1], triple[at - 2]) if len(at) else ():
                here = np.flatnonzero(grams & mask == r)
                grams, doc = grams[here], of[here]
                place, hit = lookup(grams, keys, shift, first)
                logs += np.bincount(doc[hit], weights=value[place[hit]], minlength=texts_)
                grams, doc = grams[~hit], doc[~hit]
                possible = bits.maybe(flags, grams)
                found.append(grams[possible])
                owner.append(doc[possible])
            found, owner = np.concatenate(found), np.concatenate(owner)
            rows, whole = pa.array(owner), np.arange(len(found)) < texts_
            more = np.zeros(len(found)), np.zeros(len(found), np.int64)
            more[0][:texts_] = logs
            more[1][:texts_] = tokens if r == 0 else 0
            gram = pa.array(found.view(np.int64), mask=whole)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(rows) for c in (0, 2)), batch.column(3).take(pa.array(owner, mask=~whole)), gram, *map(pa.array, more)], ["doc_id", "row", "lang", "gram", "part", "n"])

    parts = keyed.mapInArrow(run, "doc_id long, row long, lang string, gram long, part double, n long")
    whole = F.col("gram").isNull()  # the row of the text itself; its own hash spreads these rows over the join
    parts = parts.select("doc_id", "row", "lang", "part", "n", whole.alias("whole"), F.coalesce("gram", "row").alias("gram"))
    return parts.join(rare, "gram", "left").groupBy("doc_id", "row").agg(
        F.first("lang", ignorenulls=True).alias("lang"),
        F.count_if(F.col("whole") & (F.lit(r) == 0)).alias("copies"),
        F.sum("n").alias("n"),
        F.sum(F.col("part") + F.when(F.col("whole"), 0.0).otherwise(F.coalesce("value", F.lit(0.0)))).alias("logs"),
    )


def directory(keys: np.ndarray) -> tuple[np.uint64, np.ndarray]:
    """Where the sorted keys of each range of hashes begin; there are about two ranges for each key."""
    size = max(1, len(keys).bit_length() + 1)
    shift = np.uint64(64 - size)
    return shift, np.concatenate([[0], np.cumsum(np.bincount((keys >> shift).astype(np.int64), minlength=1 << size))])


def lookup(grams: np.ndarray, keys: np.ndarray, shift: np.uint64, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the n-grams in the sorted keys; which are really there."""
    own = (grams >> shift).astype(np.int64)
    place, end = first[own], first[own + 1]
    hit, open_ = np.zeros(len(grams), bool), np.flatnonzero(place < end)
    while len(open_):
        same = keys[place[open_]] == grams[open_]
        hit[open_[same]] = True
        open_ = open_[~same]
        place[open_] += 1
        open_ = open_[place[open_] < end[open_]]
    return place, hit


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "quality", shared: int = SHARED, quantile: float = QUANTILE, prior: float = PRIOR, margin: float = MARGIN) -> DataFrame:
    """doc_id, row, lang, copies, n_tokens, perplexity, drawn_perplexity, threshold, keep of each distinct row.

    Trusted are the rows whose label is 1. All of those outside the fold that sets the thresholds are learned from."""
    good = labels.filter(F.col(label_col) == 1).select(F.col(id_col).cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    rows = texts(df, id_col, text_col)
    model = train(rows.join(good.filter(~held_out("doc_id", FOLDS)), "doc_id", "left_semi"))
    scored = perplexities(df, model, id_col, text_col, lang_col, shared)
    drop_scratch(model[0])
    checked = scored.join(good.filter(held_out("doc_id", FOLDS)), "doc_id", "left_semi")
    # a short text's perplexity says little: it is drawn towards the usual one of its language
    # written first, so that their size is known and rows of one language need not meet in one task
    usual = cut_lineage(checked.groupBy("lang").agg(F.percentile_approx(F.log2("perplexity"), 0.5, 10_000).alias("usual")), "usual")
    general = checked.agg(F.percentile_approx(F.log2("perplexity"), 0.5, 10_000)).first()[0]
    drawn = F.log2("perplexity") * F.col("n_tokens") + F.coalesce("usual", F.lit(general), F.lit(0.0)) * prior
    judged = scored.join(usual, "lang", "left").withColumn("judged", drawn / (F.col("n_tokens") + prior))
    at = F.percentile_approx("judged", quantile, 10_000)
    known = judged.join(good.filter(held_out("doc_id", FOLDS)), "doc_id", "left_semi")
    limits = cut_lineage(known.groupBy("lang").agg((at + margin).alias("limit")), "limits")
    # a language without trusted rows in the fold is kept: the model may know none of its words
    out = judged.join(limits, "lang", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    return out.select(
        *scored.columns,
        F.pow(F.lit(2.0), "judged").alias("drawn_perplexity"),
        F.pow(F.lit(2.0), "limit").alias("threshold"),
        (F.col("judged") <= F.col("limit")).alias("keep"),
    )
