"""Hierarchical multi-length packing of tokenized documents.

Every document is tokenized, closed with an end id, and cut at full windows. What is left of it is
routed to the tier (context size) that just holds it. Tiers are packed from the longest to the
shortest: each leftover opens a window of its tier, and the gap behind it is filled from shorter
tiers, first with whole leftovers from the largest that fits downwards, then by cutting one. What no
window took is laid end to end. Windows of a tier are full; the few ids at the end of a block
that fill no window go into ever smaller full tiers, so that only fewer ids than the shortest tier
are ever padded. Full windows are then dealt to step groups of equal numbers of ids.

Packing needs no meeting of documents, so a block is a run of documents that one task reads, bounded
by its ids; nothing is shuffled and a lost task is redone alone.

Defined cases: a null or empty text is one end id; null document ids are packed like others; repeated
rows are packed each for itself; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from laminae.llm.columns import list_array, texts

TIERS = (4096, 2048, 1024, 512, 256)
_REMEMBER, _LONGEST, _MARKS = 600_000, 64, ".,;:!?%$&*#"
# Bytes of ASCII and of the letters À to ÿ are plain; a word with others, or that may hold a special token, is odd.
_ODD = re.compile(rb"([^ \t\n\r\x0b\x0c]*(?:[\xc2\xc4-\xff]|\xc3[\x97\xb7]|<\|)[^ \t\n\r\x0b\x0c]*)")
_PLAIN_BYTES = bytes([*range(0x80), *range(0x80, 0xC0), 0xC3])
_MARKED = re.compile(rb"([a-z\x80-\xbf])([.,;:!?%$&*#])")
# "." for full stops and commas, "a" for what they are parted from (letters, digits, white space), "b" for the rest
_KINDS = bytes(ord("." if c in b".," else "a" if c >= 0x80 or chr(c).isalnum() or c in b" \n" else "b") for c in range(256))
SCHEMA = (
    "doc_id long, start long, length long, ids array<int>, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)


class WordTokens:
    """Ids of whole texts by a tokenizer that drops white space and case and keeps punctuation apart.

    Words are remembered. Plain words are first put in lower case and parted from the punctuation behind their
    letters, which gives the same ids and far fewer different words: none of their characters combine, so case
    and normalization act on each alone. Odd words are encoded as they stand, special tokens as the tokenizer
    itself does."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        suffix = json.loads(self.tokenizer.to_str())["model"]["end_of_word_suffix"]
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if suffix and w.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}

    def _learn(self, words: list[bytes]) -> None:
        texts = [w.decode("utf-8", "replace") for w in words]
        left = []
        for w, t in zip(words, texts):
            if t.isascii() and t.isalpha():  # in lower case: one run of letters, each its own symbol
                self.known[w] = array("I", [x.id for x in self.tokenizer.model.tokenize(t)]).tobytes()
            else:
                left.append((w, t))
        # a run of letters or marks is closed by an id that ends a word: many are encoded as one text, and as many ends as
        # words mean one for each
        runs = [x for x in left if x[1].isalpha() or not x[1].strip(_MARKS)]
        for k in range(0, len(runs), 500):
            some = runs[k : k + 500]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join([t for _, t in some])], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(ends) == len(some):
                data = ids.tobytes()
                self.known.update((w, data[u:v]) for (w, _), u, v in zip(some, [0, *ends], ends))
        rest = [x for x in left if x[0] not in self.known]
        found = self.tokenizer.encode_batch_fast([t for _, t in rest], add_special_tokens=False)
        self.known.update((w, array("I", e.ids).tobytes()) for (w, _), e in zip(rest, found))

    @staticmethod
    def _plain(text: bytes) -> list[bytes]:
        """Lower case, and marks behind letters apart, but marks that follow each other left together."""
        text = text.lower()
        kinds = text.translate(_KINDS)
        if b"b." in kinds or b".." in kinds:
            return _MARKED.sub(rb"\1 \2", text).split()
        return text.replace(b", ", b" , ").replace(b". ", b" . ").replace(b".\n", b" .\n").split()

    def words(self, text: bytes) -> list[bytes]:
        """The words of a text as they are looked up. ASCII white space never takes part in a token."""
        if not text.translate(None, _PLAIN_BYTES) and not any(x in text for x in (b"\xc3\x97", b"\xc3\xb7", b"<|")):
            return self._plain(text)
        found: list[bytes] = []
        for k, part in enumerate(_ODD.split(text)):
            found += [part] if k % 2 else self._plain(part)
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed little-endian ids of each text."""
        out = []
        for i in range(0, len(texts), 64):
            split = list(map(self.words, texts[i : i + 64]))
            words = set().union(*split)
            if new := words.difference(self.known):
                if len(self.known) + len(new) > _REMEMBER:
                    self.known.clear()
                    new = words
                self._learn(list(new))
            out += [b"".join(map(self.known.__getitem__, s)) for s in split]
            for w in new:
                if len(w) > _LONGEST:
                    del self.known[w]
        return out


_tokenizers: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokens(path)
    return _tokenizers[path]


class Block:
    """Packs the documents of one block: pieces are (document, start, length)."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tuple(sorted(tiers, reverse=True))
        self.windows: list[tuple[int, list[tuple[int, int, int]]]] = []

    def _tier(self, length: int) -> int:
        """The shortest context size that holds so many ids."""
        return next(t for t in reversed(self.tiers) if length <= t)

    def pack(self, lengths: list[int]) -> list[tuple[int, list[tuple[int, int, int]]]]:
        """Windows as (tier, pieces). Only the last may hold fewer ids than its tier."""
        top = self.tiers[0]
        routed: dict[int, deque[tuple[int, int, int]]] = {t: deque() for t in self.tiers}
        for doc, n in enumerate(lengths):
            full = n - n % top
            for start in range(0, full, top):
                self.windows.append((top, [(doc, start, top)]))
            if n > full:
                routed[self._tier(n - full)].append((doc, full, n - full))
        for t in self.tiers:  # long leftovers first, so that the short ones stay for filling
            routed[t] = deque(sorted(routed[t], key=lambda p: -p[2]))
        rest: list[tuple[int, int, int]] = []
        for t in self.tiers[:-1]:
            below = [s for s in self.tiers if s < t]
            while routed[t]:
                pieces = [routed[t].popleft()]
                if gap := self._fill(pieces, t - pieces[0][2], below, routed):
                    rest += pieces
                    assert gap > 0 and not any(routed[s] for s in below)
                else:
                    self.windows.append((t, pieces))
        rest += routed[self.tiers[-1]]
        self._lay(rest)
        return self.windows

    def _fill(self, pieces: list, gap: int, below: list[int], routed: dict) -> int:
        """Fills the gap from shorter tiers; what stays open when these are empty."""
        for s in below:
            while gap and routed[s] and routed[s][-1][2] <= gap:
                fits = routed[s].popleft() if routed[s][0][2] <= gap else routed[s].pop()
                pieces.append(fits)
                gap -= fits[2]
        for s in reversed(below):  # nothing whole fits any more: cut the shortest leftover
            if gap and routed[s]:
                doc, start, n = routed[s].pop()
                taken = min(n, gap)
                pieces.append((doc, start, taken))
                gap -= taken
                if n > taken:
                    self._back((doc, start + taken, n - taken), routed)
                return self._fill(pieces, gap, below, routed) if gap else 0
        return gap

    def _back(self, piece: tuple[int, int, int], routed: dict) -> None:
        """Puts the rest of a cut leftover into its tier, which stays sorted by falling length."""
        tier, passed = routed[self._tier(piece[2])], []
        while tier and tier[-1][2] < piece[2]:
            passed.append(tier.pop())
        tier.append(piece)
        tier.extend(reversed(passed))

    def _lay(self, rest: list[tuple[int, int, int]]) -> None:
        """End to end into full windows, then into ever shorter ones."""
        left, queue = sum(p[2] for p in rest), deque(rest)
        while left:
            tier = next((t for t in self.tiers if t <= left), self.tiers[-1])
            pieces, room = [], min(tier, left)
            left -= room
            while room:
                doc, start, n = queue.popleft()
                taken = min(n, room)
                pieces.append((doc, start, taken))
                room -= taken
                if n > taken:
                    queue.appendleft((doc, start + taken, n - taken))
            self.windows.append((tier, pieces))


def step_groups(windows: list[tuple[int, list]], step_ids: int) -> list[int]:
    """The step of each window: the longest windows first, each to the first step that has room,
    so all steps of a block but the last hold the same number of ids."""
    group, used, out = 0, 0, [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: -windows[i][0]):
        if used + windows[i][0] > step_ids:
            group, used = group + 1, 0
        out[i], used = group, used + windows[i][0]
    return out


def pack(
    df: DataFrame,
    path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    tiers: tuple[int, ...] = TIERS,
    block_ids: int = 4_000_000,
    step_ids: int = 65_536,
) -> DataFrame:
    """One row for each piece, with its ids. Sequence numbers hold the task's number in their upper
    bits. tiers are powers of two; a block is closed when it holds block_ids ids, looked at every 512 documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, end = word_tokens(path), np.array([end_id], "<u4").tobytes()
        sequence = steps = TaskContext.get().partitionId() << 36

        def close(docs: list, ids: list[bytes]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, steps
            windows = Block(tiers).pack([len(x) // 4 for x in ids])
            groups = step_groups(windows, step_ids)
            rows = []
            for (tier, pieces), group in zip(windows, groups):
                offset = 0
                for doc, start, n in pieces:
                    rows.append((docs[doc], start, n, doc, sequence, offset, tier, steps + group))
                    offset += n
                sequence += 1
            steps += max(groups, default=-1) + 1
            for i in range(0, len(rows), 5000):
                yield piece_batch(rows[i : i + 5000], ids)

        docs, ids, size = [], [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                docs += part.column(0).to_pylist()
                found = of.encode(part.column(1).to_pylist())
                ids += [x + end for x in found]
                size += sum(map(len, found)) // 4
                if size >= block_ids:
                    yield from close(docs, ids)
                    docs, ids, size = [], [], 0
        yield from close(docs, ids)

    return texts(df, id_col, text_col).mapInArrow(run, SCHEMA)


def piece_batch(rows: list[tuple], ids: list[bytes]) -> pa.RecordBatch:
    cut = [ids[doc][4 * start : 4 * (start + n)] for _, start, n, doc, *_ in rows]
    column = lambda i, kind: pa.array([r[i] for r in rows], kind)
    return pa.RecordBatch.from_arrays(
        [
            column(0, pa.int64()),
            column(1, pa.int64()),
            column(2, pa.int64()),
            list_array(cut, pa.int32()),
            pa.array([len(ids[r[3]]) // 4 for r in rows], pa.int64()),
            column(4, pa.int64()),
            column(5, pa.int64()),
            column(6, pa.int32()),
            column(7, pa.int64()),
        ],
        ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_group"],
    )


def with_crc(pieces: DataFrame) -> DataFrame:
    """Replaces ids by ids_crc32, the unsigned CRC-32 of the ids as little-endian 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            starts, data = ids.offsets.to_numpy(), memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(starts.tolist(), starts[1:].tolist())]
            columns = [*batch.columns[:3], pa.array(crc, pa.int64()), *batch.columns[4:]]
            names = [n if n != "ids" else "ids_crc32" for n in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return pieces.mapInArrow(run, SCHEMA.replace("ids array<int>", "ids_crc32 long"))
