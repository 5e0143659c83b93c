"""Byte-level BPE by dynamic programming over prefixes.

The BPE encoding of a piece is the one token sequence in which every neighbouring pair is *compatible*:
encoding the two tokens' joined bytes gives those two tokens back. Every prefix of a piece therefore has
exactly one possible last token: a vocabulary token that ends there and is compatible with the last token
of the prefix before it. An automaton over the vocabulary reports the tokens ending at each byte, the
compatible one is stored for each prefix, and back-pointers from the end give the ids. No merge loop runs,
and a piece of any length takes time in proportion to its length.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rollwright.llm import tokens
from rollwright.llm.common import keyed_texts, small_batches

NEVER = 1 << 60


class PrefixEncoder:
    """Encodes and decodes with one vocabulary; a worker keeps one."""

    def __init__(self, path: str) -> None:
        self.ids, self.special, merges = tokens.vocabulary(path)
        letters = tokens.letter_bytes()
        self.bytes_of = {number: token for token, number in self.ids.items()}
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for merge in merges:
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = (self.ids[bytes(letters[c] for c in side)] for side in (left, right))
            joined = self.ids[self.bytes_of[a] + self.bytes_of[b]]
            self.pair[a, b] = joined
            self.parts[joined] = (a, b)
        self.pieces = regex.compile(tokens.BYTE_PATTERN)
        self.breaks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.known: dict[str, bytes] = {}
        self.compatible = functools.lru_cache(tokens.CACHE_ENTRIES)(self._compatible)
        self.edge = functools.lru_cache(None)(self._edge)

    @functools.cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Reports the tokens that end at each byte; only encoding needs it."""
        automaton = ahocorasick.Automaton()
        for token, number in self.ids.items():
            automaton.add_word(token.decode("latin-1"), (len(token), number))
        automaton.make_automaton()
        return automaton

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens at one edge of a token while it is built, latest first, each with the rank that ends it."""
        found, ends = [], NEVER
        while True:
            found.append((token, ends))
            if token not in self.parts:
                return found
            ends, token = token, self.parts[token][side]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether no merge ever reaches over the border between two tokens.

        A merge of rank ``m`` joins the pieces on both sides of the border if both exist when its turn
        comes: neither has been merged into a larger piece of its own token yet. Of equal ranks the merge
        further left comes first, so an inner merge of the left token wins and one of the right token loses.
        """
        for a, a_ends in self.edge(left, 1):
            for b, b_ends in self.edge(right, 0):
                rank = self.pair.get((a, b))
                if rank is not None and rank < a_ends and rank <= b_ends:
                    return False
        return True

    def piece(self, piece: str) -> bytes:
        """Ids of one pre-token, as little-endian unsigned 32-bit bytes."""
        data = piece.encode()
        if data in self.ids:
            return self.ids[data].to_bytes(4, "little")
        last: list[int] = [-1] * (len(data) + 1)
        compatible = self.compatible
        for end, (size, token) in self.automaton.iter(data.decode("latin-1")):
            if last[end + 1] < 0:
                before = end + 1 - size
                if before == 0 or (last[before] >= 0 and compatible(last[before], token)):
                    last[end + 1] = token
        ids, end = [], len(data)
        while end:
            ids.append(last[end])
            end -= len(self.bytes_of[last[end]])
        return np.array(ids[::-1], dtype="<u4").tobytes()

    def plain(self, text: str) -> bytes:
        found = self.pieces.findall(text)
        new = set(found).difference(self.known)
        if len(self.known) + len(new) > tokens.CACHE_ENTRIES:
            self.known.clear()
            new = set(found)
        for piece in new:
            self.known[piece] = self.piece(piece)
        return b"".join(map(self.known.__getitem__, found))

    def encode(self, text: str | None) -> bytes:
        return tokens.with_special(text, self.special, self.breaks, self.plain)


class Speller:
    """Texts from ids; holds no more than the bytes of every id."""

    def __init__(self, path: str) -> None:
        ids, special, _ = tokens.vocabulary(path)
        every = {number: token for token, number in ids.items()} | {n: token.encode() for token, n in special.items()}
        self.spelled = [every.get(i, b"") for i in range(max(every) + 1)]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.spelled.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@functools.cache
def prefix_encoder(path: str) -> PrefixEncoder:
    """One for each Python worker."""
    return PrefixEncoder(path)


@functools.cache
def speller(path: str) -> Speller:
    """One for each Python worker."""
    return Speller(path)


ENCODED = "doc_id long, ids binary"
DECODED = "doc_id long, ids binary, text string"


def encode_documents(df: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of each row's whole text.

    Null and empty texts have no ids; each row gives one row, repeated rows and rows without an id too;
    other columns are left out. A special token's string inside a text becomes that token, as the
    ``tokenizers`` library has it.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = prefix_encoder(path)
        for batch in small_batches(batches):
            ids = pa.array(map(encoder.encode, batch.column("text").to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return keyed_texts(df, id_column, text_column).mapInArrow(encode, ENCODED)


def decode_documents(df: DataFrame, path: str) -> DataFrame:
    """Adds ``text`` to the rows of :func:`encode_documents`, from the ids alone; null ids give ''."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = speller(path)
        for batch in small_batches(batches):
            texts = [held.decode(ids or b"") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return df.select("doc_id", "ids").mapInArrow(decode, DECODED)
