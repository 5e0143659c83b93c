"""Token ids of whole texts, for use inside tasks.

Ids equal those of the ``tokenizers`` library for the same vocabulary file with
``add_special_tokens=False``; tests hold them against it. Caches live in a Python worker, hold at most
``CACHE_ENTRIES`` pieces of text and are emptied when full.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Callable

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

CACHE_ENTRIES = 150_000

# The pre-token patterns named in the vocabulary files, and their special tokens.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


@functools.cache
def letter_bytes() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for.

    Printable Latin-1 bytes stand for themselves, the others take the code points from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int], list]:
    """Token bytes to id (an end of word is written as a zero byte), special tokens, merges."""
    with open(path, encoding="utf-8") as file:
        held = json.load(file)
    special = {token["content"]: token["id"] for token in held["added_tokens"]}
    letters = letter_bytes()
    ids = {}
    for token, number in held["model"]["vocab"].items():
        if token in special:
            continue
        body = token.removesuffix(WORD_END) if held["model"]["end_of_word_suffix"] else token
        ids[bytes(letters[c] for c in body) + (b"\0" if body != token else b"")] = number
    return ids, special, held["model"]["merges"]


class ByteEncoder:
    """Byte-level vocabulary: ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        ids, self.special, _ = vocabulary(path)
        self.breaks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.merge = tiktoken.Encoding("byte_level", pat_str=BYTE_PATTERN, mergeable_ranks=ids, special_tokens={})

    def plain(self, text: str) -> bytes:
        """Ids of a text that holds no special token."""
        return np.asarray(self.merge.encode_ordinary(text), dtype="<u4").tobytes()

    def encode(self, text: str | None) -> bytes:
        return with_special(text, self.special, self.breaks, self.plain)


def with_special(text: str | None, special: dict[str, int], breaks: regex.Pattern, plain: Callable[[str], bytes]) -> bytes:
    """Ids of a text whose special tokens, if any, part it into pieces that ``plain`` encodes."""
    if not text:
        return b""
    if not any(token in text for token in special):
        return plain(text)
    return b"".join(
        np.array([special[part]], dtype="<u4").tobytes() if part in special else plain(part)
        for part in breaks.split(text)
    )


class WordEncoder:
    """Vocabulary with word ends, lower case, white space dropped: white space parts chunks.

    Each distinct chunk is encoded once, until the cache is full and starts anew.
    """

    # Separators for Python's split that are no white space to the tokenizer, and the byte that stands for a word end.
    ODD = ("\x1c", "\x1d", "\x1e", "\x1f", "\0")

    def __init__(self, path: str) -> None:
        self.known: dict[str, bytes] = {}
        ids, self.special, _ = vocabulary(path)
        self.words = regex.compile(WORD_PATTERN)
        self.ends = np.zeros(max(ids.values()) + 1, dtype=bool)
        self.ends[[number for token, number in ids.items() if len(token) > 1 and token.endswith(b"\0")]] = True
        self.merge = tiktoken.Encoding("word_ends", pat_str="[^ ]+", mergeable_ranks=ids, special_tokens={}).encode_ordinary
        self.whole = Tokenizer.from_file(path)

    def learn(self, chunks: set[str]) -> None:
        """Words of all new chunks are merged in one call; each word ends in exactly one end token."""
        order = list(chunks)
        words = [
            self.words.findall(c.lower() if c.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", c))))
            for c in order
        ]
        joined = "\0 ".join(word for found in words for word in found)
        ids = np.asarray(self.merge(joined + "\0"), dtype="<u4") if joined else np.empty(0, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        bounds = np.concatenate([[0], ends])[np.cumsum([0, *map(len, words)])] * 4
        held = ids.tobytes()
        for i, chunk in enumerate(order):
            self.known[chunk] = held[bounds[i] : bounds[i + 1]]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(x in text for x in self.ODD) or any(token in text for token in self.special):
            return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        chunks = text.split()
        new = set(chunks).difference(self.known)
        if new:
            if len(self.known) + len(new) > CACHE_ENTRIES:
                self.known.clear()
                new = set(chunks)
            self.learn(new)
        return b"".join(map(self.known.__getitem__, chunks))


@functools.cache
def byte_encoder(path: str) -> ByteEncoder:
    """One for each Python worker."""
    return ByteEncoder(path)


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    """One for each Python worker."""
    return WordEncoder(path)
