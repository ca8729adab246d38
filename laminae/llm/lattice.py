"""Language-model scoring by the marginal likelihood of subword lattices.

A text is its words in ASCII lower case and one end. Each word, with the vocabulary's mark of a word
start before it, spans a lattice of all its segmentations into pieces of an existing vocabulary; the
unigram scores of the pieces weight them, and the forward recursion in log space sums over all of them.
Characters that no piece holds are spelled with the vocabulary's byte pieces. No piece reaches over a
word start, so words are independent given their probabilities.

The vocabulary is never changed. Its order gives first scores (a piece's share falls with its rank), and
the scores are then fitted by expectation maximisation over all distinct training words. A word seen
in training is one more edge, from its start to its end, weighted by its discounted share of the training
tokens; what the discount frees is shared by all spellings, so probabilities add up to at most one.
Within a text, words are drawn from these probabilities with reinforcement (a Polya urn of the given
concentration): a word already seen in the text is likelier to come again. The product does not
depend on the order, so the score is a sum over the text's distinct words. For the frequent words it
is a mixture: a text is drawn from all languages together or from one of those with at least a fiftieth of the
training tokens (so they are at most fifty), each with its own counts of these words. Languages are
looked at in training rows only, and of the other rows nothing is learned: their scores stay the same
whatever other such rows there are.

The corpus enters as one table of distinct words with their counts. Each distinct word's lattice is
summed once, wherever the word occurs. Documents meet that table by word: the words of at least
1/heavy of all tokens, which are at most heavy, are sent to every task, and the rest are joined, where
no word is frequent any more.

Defined cases: null and empty texts score the end alone; a null language is one of its own; a null id is
held out; repeated rows are scored and learned from each for itself; with no training rows every count
is zero; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import exp, inf, lgamma, log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from laminae.llm.columns import held_out, texts
from laminae.session import cut_lineage

START = "▁"
END = b""  # no word is empty, so this stands for the end
HEAVY, DISCOUNT, CONCENTRATION, SMOOTH, ROUNDS, FLUSH = 400_000, 0.5, 2000.0, 200.0, 1, 200_000
MIN_SHARE = 0.02  # of the training tokens, for a language to be a part of the mixture


class Lattice:
    """All segmentations of a word under one log probability for each piece."""

    def __init__(self, path: str, scores: np.ndarray | None = None):
        model = SentencePieceProcessor(model_file=path)
        self.size, self.end = model.get_piece_size(), model.eos_id()
        pieces = [i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i))]
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): i for i in pieces if model.is_byte(i)}
        if scores is None:
            prior = np.zeros(self.size)
            prior[pieces] = 1 / np.arange(1, len(pieces) + 1)
            prior[list(self.bytes.values())] = prior[pieces].min()
            prior[self.end] = prior.mean()
            scores = np.log(prior / prior.sum(), where=prior > 0, out=np.full(self.size, -inf))
        self.score = scores.tolist()  # -inf for what is no piece and the automaton never finds
        self.find = ahocorasick.Automaton()
        self.characters = set()
        for i in pieces:
            if i not in set(self.bytes.values()):
                text = model.id_to_piece(i)
                self.find.add_word(text, (i, len(text)))
                if len(text) == 1:
                    self.characters.add(text)
        self.find.make_automaton()

    def edges(self, word: str) -> list[list[tuple[int, float, int]]]:
        """For each end position: start, log probability and piece of each way to reach it; -1 for a
        character that is spelled in bytes."""
        into: list[list] = [[] for _ in range(len(word) + 1)]
        score = self.score
        for last, (i, n) in self.find.iter(word):
            into[last + 1].append((last + 1 - n, score[i], i))
        if not self.characters.issuperset(word):
            for at, c in enumerate(word):
                if c not in self.characters:
                    into[at + 1].append((at, sum(score[i] for i in self.spelling(c)), -1))
        return into

    def spelling(self, character: str) -> list[int]:
        return [self.bytes[b] for b in character.encode("utf-8", "surrogatepass")]

    def forward(self, into: list) -> list[float]:
        alpha = [0.0]
        for ways in into[1:]:
            if len(ways) == 1:
                alpha.append(alpha[ways[0][0]] + ways[0][1])
            else:
                terms = [alpha[start] + s for start, s, _ in ways]
                top = max(terms)
                alpha.append(top + log(sum([exp(t - top) for t in terms])))
        return alpha

    def word(self, word: bytes) -> float:
        """Natural log of the sum over all segmentations; of the end's own for END."""
        if word == END:
            return self.score[self.end]
        return self.forward(self.edges(START + word.decode("utf-8", "replace")))[-1]

    def expected(self, word: bytes, into_counts: list[float]) -> None:
        """Adds the expected number of each piece in the word's segmentations."""
        if word == END:
            into_counts[self.end] += 1
            return
        text = START + word.decode("utf-8", "replace")
        into = self.edges(text)
        alpha = self.forward(into)
        behind = [0.0] * len(into)  # the probability of passing each position, given the word
        behind[-1] = 1.0
        for at in range(len(into) - 1, 0, -1):
            passing = behind[at]
            if passing < 1e-12:
                continue
            a = alpha[at]
            for start, s, i in into[at]:
                share = passing * exp(alpha[start] + s - a)
                behind[start] += share
                if i >= 0:
                    into_counts[i] += share
                else:
                    for b in self.spelling(text[at - 1]):
                        into_counts[b] += share


def word_counts(df: DataFrame, folds: int, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """word, lang and n of each distinct word of each language in the training rows; the words of other rows come with
    a null language and 0. Words are counted within tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned: dict[str | None, Counter] = {}
        new = 0

        def flush() -> Iterator[pa.RecordBatch]:
            while learned:
                lang, n = learned.popitem()
                counts = np.fromiter(n.values(), np.int64, len(n)) * (lang is not None)
                yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), pa.array([lang] * len(n), pa.string()), pa.array(counts)], ["word", "lang", "n"])

        for batch in batches:
            for text, out_, lang in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = text.as_py().lower().split()
                words.append(END)
                held = learned.setdefault(None if out_ else lang, Counter())
                new -= len(held)
                held.update(words)
                new += len(held)
                if new > FLUSH:
                    yield from list(flush())
                    new = 0
        yield from list(flush())

    more = {"held_out": held_out(id_col, folds), "lang": F.coalesce(F.col(lang_col).cast("string"), F.lit(""))}
    made = texts(df, id_col, text_col, **more).mapInArrow(run, "word binary, lang string, n long")
    return made.groupBy("word", "lang").agg(F.sum("n").alias("n"))


def fit(words: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """The pieces' scores after so many rounds of expectation maximisation over all distinct training words."""
    first = Lattice(path)
    base = np.array(first.score)
    scores: np.ndarray | None = None
    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], scores=scores) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(path, scores)
            sums = [0.0] * lattice.size
            for batch in batches:
                for word in batch.column(0).to_pylist():
                    lattice.expected(word, sums)
            used = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.array(sums)[used])], ["piece", "n"])

        found = words.filter("n > 0").select("word").mapInArrow(expect, "piece long, n double")
        rows = found.groupBy("piece").agg(F.sum("n").alias("n")).collect()  # one for each piece
        total = np.where(base > -inf, 0.1, 0.0)
        for r in rows:
            total[r["piece"]] += r["n"]
        if rows:
            scores = np.log(total / total.sum(), where=total > 0, out=np.full(len(total), -inf))
    return base if scores is None else scores


def score(
    df: DataFrame,
    path: str,
    folds: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    heavy: int = HEAVY,
    discount: float = DISCOUNT,
    concentration: float = CONCENTRATION,
    rounds: int = ROUNDS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each whole text."""
    counts = cut_lineage(word_counts(df, folds, id_col, text_col, lang_col), "words")
    distinct = cut_lineage(counts.groupBy("word").agg(F.sum("n").alias("n")), "distinct")
    scores = fit(distinct, path, rounds)

    def lattices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(path, scores)
        for batch in batches:
            spelled = pa.array(list(map(lattice.word, batch.column(0).to_pylist())), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, spelled], ["word", "n", "spelled"])

    words = cut_lineage(distinct.mapInArrow(lattices, "word binary, n long, spelled double"), "lattices")
    totals = words.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    n_all, kinds = totals["n"] or 0, totals["v"]
    spell = discount * kinds / n_all if n_all else 1.0
    # natural log of the concentration times the word's probability
    drawn = F.when(F.col("n") > 0, F.log((F.col("n") - discount) / (n_all or 1) + spell * F.exp("spelled"))).otherwise(F.col("spelled") + log(spell))
    table = words.select(
        "word", "n", F.log10((F.col("n") + 0.1) / (n_all + 0.1 * (kinds + 1))).alias("base"), (drawn + log(concentration)).alias("mass")
    )
    frequent = table.filter((F.col("n") > 0) & (F.col("n") * heavy >= n_all)).collect()  # at most heavy rows
    shared = df.sparkSession.sparkContext.broadcast(_by_language(counts, [(bytes(r["word"]), r["base"], r["mass"]) for r in frequent], min_share))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, of what the shared words give, and one for each other word in it."""
        place, base_of, mass_of, prior = shared.value
        plain = np.exp(mass_of)
        for batch in batches:
            at, word, times, tokens, known, base, full = [], [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                words = text.as_py().lower().split()
                words.append(END)
                met, n = [], []
                for w, c in Counter(words).items():
                    hit = place.get(w)
                    if hit is None:
                        at.append(i), word.append(w), times.append(c)
                    else:
                        met.append(hit), n.append(c)
                at.append(i), word.append(None), times.append(0)
                counted = np.array(n, np.int64)
                tokens.append(len(words)), known.append(sum(n)), base.append(float((base_of[met] * counted).sum()))
                # the likelihood under each language, then the mixture
                drawn = prior + mass_of[:, met].sum(axis=1)
                for j in np.flatnonzero(counted > 1):
                    drawn += [lgamma(m + n[j]) - lgamma(m + 1) for m in plain[:, met[j]].tolist()]
                top = drawn.max()
                full.append(top + log(np.exp(drawn - top).sum()) + lgamma(concentration) - lgamma(concentration + len(words)))
            ends = np.flatnonzero(np.array(times) == 0)

            def sparse(values: list, kind: type) -> pa.Array:
                out = np.zeros(len(at), kind)
                out[ends] = values
                return pa.array(out)

            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(word, pa.binary()), pa.array(times, pa.int32()),
                 sparse(tokens, np.int64), sparse(known, np.int64), sparse(base, np.float64), sparse(full, np.float64)],
                ["doc_id", "row", "word", "times", "tokens", "known", "base_part", "full_part"],
            )

    keyed = texts(df, id_col, text_col, row=F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string")))
    parts = keyed.mapInArrow(split, "doc_id long, row long, word binary, times int, tokens long, known long, base_part double, full_part double")
    # the rows of whole texts carry no word; their own hash keeps them apart in the join
    parts = parts.withColumn("word", F.coalesce("word", F.concat(F.lit(" "), F.col("row").cast("string")).cast("binary")))
    joined = parts.join(table, "word", "left")
    times, mass = F.col("times"), F.col("mass")
    again = F.aggregate(F.sequence(F.lit(1), times - 1), F.lit(0.0), lambda s, j: s + F.log(F.exp(mass) + j))
    rise = F.when(times == 1, mass).when(times > 1, mass + again).otherwise(0.0)
    summed = joined.groupBy("doc_id", "row").agg(
        F.count_if(times == 0).alias("copies"),
        F.sum("tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("n") > 0, times).otherwise(0)).alias("n_known"),
        F.sum(F.col("base_part") + times * F.coalesce("base", F.lit(0.0))).alias("base_score"),
        F.sum(F.col("full_part") + rise).alias("score"),
    )
    # rows equal in id and text were summed together: give each its own share back
    share = lambda c: F.col(c) / F.col("copies")
    return summed.select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"), "*").select(
        "doc_id",
        held_out("doc_id", folds).alias("held_out"),
        share("n_tokens").cast("long").alias("n_tokens"),
        share("n_known").cast("long").alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        share("base_score").alias("base_score"),
        (share("score") / log(10)).alias("score"),
    )


def _by_language(counts: DataFrame, words: list[tuple[bytes, float, float]], min_share: float) -> tuple:
    """The shared words' places, base scores and log masses under all languages together (first) and under
    each of those that have min_share of the training tokens or more, with the log share of each.

    In a language, the shared words keep their total mass and divide it by their counts in the language,
    smoothed by their own masses."""
    place = {w: i for i, (w, _, _) in enumerate(words)}
    base, mass = np.array([b for _, b, _ in words]), np.array([m for _, _, m in words])
    spark = counts.sparkSession
    sizes = counts.filter("n > 0").groupBy("lang").agg(F.sum("n").alias("n"))
    whole = sizes.agg(F.sum("n")).first()[0] or 0
    usual = sizes.filter(F.col("n") >= min_share * whole).orderBy(F.desc("n"), "lang").collect()  # at most 1 / min_share
    if not words or not usual:
        return place, base, mass[None, :], np.zeros(1)
    listed = F.broadcast(spark.createDataFrame([(bytearray(w),) for w in place], "word binary"))  # at most heavy rows
    rows = counts.filter(F.col("n") > 0).filter(F.col("lang").isin([r["lang"] for r in usual])).join(listed, "word").select("word", "lang", "n").toLocalIterator()
    own = {r["lang"]: np.zeros(len(words)) for r in usual}
    for r in rows:
        own[r["lang"]][place[bytes(r["word"])]] = r["n"]
    total = np.exp(mass).sum()
    shape = np.exp(mass) / total
    each = [np.log(total * (n + SMOOTH * shape) / (n.sum() + SMOOTH)) for n in own.values()]
    share = np.array([r["n"] for r in usual], np.float64)
    prior = np.log(np.append([0.1], 0.9 * share / share.sum()))
    return place, base, np.stack([mass, *each]), prior
