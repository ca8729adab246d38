"""Byte-level BPE encoding and decoding against a public rank file.

The vocabulary's byte strings, written as Latin-1, form an Aho-Corasick automaton. A piece of text is
encoded by taking the longest vocabulary match at each position and keeping it only while it is
compatible with the token before it, that is while merging the two tokens' bytes together gives just
these two tokens. Where no match fits, the encoder steps back and marks the position as dead, so
every position is left at most once for each token that can begin there. A sequence in which every
adjacent pair is compatible is the one that the merges produce.

Defined cases: a null or empty text has no ids; ids that are null or unknown to the vocabulary raise
on decoding; null document ids and repeated rows pass through, one output row for each input row.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from laminae.llm.columns import list_array, texts

# Unicode white space, as the splitting pattern's \s has it.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# No match of the splitting pattern reaches over the borders of these chunks: a run of visible
# characters with one space before it, or white space. Chunks repeat often, so they are remembered.
_CHUNK = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_REMEMBER, _LONGEST = 400_000, 64


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Pieces(dict):
    """Packed ids of each piece of a chunk, remembered: chunks differ by punctuation more than by words."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encoder.encode_piece(piece.encode()), "<i4").tobytes()
        if len(piece) <= _LONGEST:
            if len(self) >= _REMEMBER:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Exact BPE of single pieces, by longest matches and adjacent compatibility."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.matches = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.matches.add_word(token.decode("latin-1"), rank)
        self.matches.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}
        self.chunks: dict[str, bytes] = {}
        self.pieces = Pieces(self)

    def merge(self, text: bytes) -> list[int]:
        """The merges in order of rank, one after the other; only for the bytes of two tokens."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, len(self.ranks) + 1), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank > len(self.ranks):
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) >= _REMEMBER:
                self.fits.clear()
            known = self.merge(self.token[left] + self.token[right]) == [left, right]
            self.fits[left, right] = known
        return known

    def shorten(self, rank: int) -> int:
        """The longest other token that begins this one; -1 if there is none."""
        found = self.shorter.get(rank)
        if found is None:
            token = self.token[rank]
            found = next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), -1)
            self.shorter[rank] = found
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text = piece.decode("latin-1")
        greedy = [rank for _, rank in self.matches.iter_long(text)]
        if all(map(self.compatible, greedy, greedy[1:])):
            return greedy
        out: list[int] = []
        at, end, dead = 0, len(text), set()
        candidate = greedy[0]
        while at < end:
            while candidate >= 0:
                after = at + len(self.token[candidate])
                if after not in dead and (not out or self.compatible(out[-1], candidate)):
                    break
                candidate = self.shorten(candidate)
            if candidate >= 0:
                out.append(candidate)
                at = after
                if at < end:
                    candidate = next(self.matches.iter_long(text, at))[1]
            else:
                dead.add(at)
                candidate = out.pop()  # IndexError: the vocabulary lacks a single byte
                at -= len(self.token[candidate])
        return out

    def encode_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(chunk)))

    def encode(self, text: str) -> bytes:
        """Packed little-endian 32-bit ids."""
        chunks, known, out = _CHUNK.findall(text), self.chunks, []
        for chunk in chunks:
            ids = known.get(chunk)
            if ids is None:
                ids = self.encode_chunk(chunk)
                if len(chunk) <= _LONGEST:
                    if len(known) >= _REMEMBER:
                        known.clear()
                    known[chunk] = ids
            out.append(ids)
        return b"".join(out)


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(load_ranks(path), pattern)
    return _encoders[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of each whole text. No special tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(path, pattern)
        for batch in batches:
            ids = [of.encode(t.as_py().decode("utf-8", "replace")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), list_array(ids, pa.int32())], ["doc_id", "ids"])

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Adds decoded (binary) to doc_id and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = encoder(path, pattern).token
        for batch in batches:
            ids = batch.column(1)
            starts, values = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
            data = [b"".join(map(token.__getitem__, values[a:b].tolist())) for a, b in zip(starts, starts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.array(data, pa.binary())], ["doc_id", "ids", "decoded"])

    return df.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
