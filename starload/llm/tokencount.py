"""Exact token counts of every prefix of a text, for byte-level BPE.

Within a piece (a word with its blank, a run of digits, ...) the encoding of a
prefix ends in exactly one token.  Dynamic programming finds it from left to
right: of the tokens that end at the place, it is the one whose pair with the
last token of the shorter prefix is left alone by the merges, and the count is
that prefix's count plus one.  The counts of a piece hold for all its prefixes,
so pieces are computed once and put together by adding up.

A text's table answers, without encoding again, how many tokens any prefix has
and which is the longest prefix within a budget.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import free_name, ship

TOKENIZER = "byte_bpe_50k.json"


def _byte_letters() -> dict[str, int]:
    """The letters by which vocabularies of this kind write bytes: printable
    characters stand for themselves, the others for letters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Bounded(dict):
    """A memory of a function's results that starts afresh when it is full."""

    def __init__(self, function, limit: int):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, key):
        value = self.function(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


class PrefixCounter:
    """Token counts of all prefixes, for a vocabulary file of ``tokenizers``."""

    #: Longer pieces are rare and large; they are not remembered.
    KEEP = 48

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        pre = spec["pre_tokenizer"] or {}
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or pre.get("type") != "ByteLevel":
            raise ValueError("only byte-level BPE without a normalizer is supported")
        if pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only plain byte-level splitting is supported")
        letters = _byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens with stripping or word bounds are not supported")
        special_ids = {t["content"] for t in spec["added_tokens"]}
        self.vocab = {raw(t) for t in spec["model"]["vocab"] if t not in special_ids}
        merges = (m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"])
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        # all tokens that end at a place, longest first
        self.tokens = sorted(self.vocab)
        self.ending = ahocorasick.Automaton()
        for i, token in enumerate(self.tokens):
            self.ending.add_word(token.decode("latin-1"), (i, len(token)))
        self.ending.make_automaton()
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.special = regex.compile("|".join(map(regex.escape, self.specials))) if self.specials else None
        self.runs = regex.compile(r"\s\s+(?=\S)")
        self.short = regex.compile(r"'(?:re|ve|ll)")
        self.stands = _Bounded(self._stands, 1_000_000)
        self.known = _Bounded(self._counts, 400_000)

    def encode(self, data: bytes) -> list[bytes]:
        """Tokens of a short piece by merging the pair of lowest rank first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            at = min(range(len(parts) - 1), key=lambda i: (self.rank.get((parts[i], parts[i + 1]), 1 << 60), i))
            if (parts[at], parts[at + 1]) not in self.rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _stands(self, pair: int) -> bool:
        """Whether the merges leave two neighbouring tokens as they are."""
        two = [self.tokens[i] for i in divmod(pair, len(self.tokens))]
        return self.encode(two[0] + two[1]) == two

    def _counts(self, piece: str) -> bytes:
        """Counts at the end of each character of a piece, 4 bytes each."""
        data = piece.encode()
        last, count = [0] * (len(data) + 1), [0] * (len(data) + 1)
        stands, many, done = self.stands, len(self.tokens), -1
        for end, (token, size) in self.ending.iter(data.decode("latin-1")):
            if end != done:
                start = end + 1 - size
                if not start or stands[last[start] * many + token]:
                    last[end + 1], count[end + 1], done = token, count[start] + 1, end
        counts = array("I", count[1:])
        if len(data) == len(piece):
            return counts.tobytes()
        lead = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
        return np.frombuffer(counts, "<u4")[np.append(np.flatnonzero(lead)[1:], len(data)) - 1].tobytes()

    def _of(self, piece: str) -> bytes:
        return self.known[piece] if len(piece) <= self.KEEP else self._counts(piece)

    def _plain(self, text: str) -> np.ndarray:
        """Counts at 0 .. len(text) for a text without special strings."""
        if not text:
            return np.zeros(1, np.int64)
        known, keep = self.known, self.KEEP
        parts = [known[p] if len(p) <= keep else self._counts(p) for p in self.split(text)]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        inside = np.frombuffer(b"".join(parts), "<u4").astype(np.int64)
        ends = np.cumsum(sizes)
        base = np.cumsum(inside[ends - 1])
        table = np.zeros(len(text) + 1, np.int64)
        table[1:] = inside
        table[1:] += np.repeat(np.concatenate(([0], base[:-1])), sizes)
        # a prefix that ends within a contraction does not contain it yet
        for m in self.short.finditer(text):
            at = m.start()
            where = np.searchsorted(ends, at)
            if at == 0 or (where < len(ends) and ends[where] == at):
                table[at + 2] = table[at] + sum(
                    int.from_bytes(self._of(c)[-4:], "little") for c in text[at : at + 2])
        # a prefix that ends with white space has all of it in one piece; in the
        # text the last blank goes with the next word
        for m in self.runs.finditer(text):
            table[m.end()] = table[m.start()] + int.from_bytes(self._of(m.group())[-4:], "little")
        return table

    def table(self, text: str | None) -> np.ndarray:
        """Exact token counts of all prefixes, by length in code points."""
        text = text or ""
        if self.special is None or not (found := list(self.special.finditer(text))):
            return self._plain(text)
        parts, base, at = [], 0, 0
        for m in found:
            # inside the special string a prefix holds only its beginning
            part = self._plain(text[at : m.end() - 1])
            parts.append(part + base)
            base += int(part[m.start() - at]) + 1
            at = m.end()
        parts.append(self._plain(text[at:]) + base)
        return np.concatenate(parts)


@lru_cache(maxsize=4)
def counter(name: str) -> PrefixCounter:
    return PrefixCounter(public_tokenizers.path(name))


def longest_within(table: np.ndarray, budget: int) -> int:
    """Length of the longest prefix with at most ``budget`` tokens."""
    return int(np.flatnonzero(table <= budget)[-1])


def pack(table: np.ndarray) -> bytes:
    """A table for storage: differences, deflated."""
    steps = np.diff(table)
    small = "<i1" if not len(steps) or abs(steps).max() < 128 else "<i4"
    return small[-1:].encode() + zlib.compress(steps.astype(small).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    steps = np.frombuffer(zlib.decompress(packed[1:]), f"<i{packed[:1].decode()}").astype(np.int64)
    return np.concatenate(([0], np.cumsum(steps)))


_RESULT = "n_tokens long, fit_chars long, prefix_tokens binary"


def count_tokens(
    spark: SparkSession,
    docs: DataFrame,
    text: str = "text",
    budget: int = 512,
    tokenizer: str = TOKENIZER,
    store: bool = True,
) -> DataFrame:
    """``docs`` plus ``n_tokens``, ``fit_chars`` (code points of the longest
    prefix within ``budget`` tokens) and, if ``store``, ``prefix_tokens`` (the
    packed table; see ``unpack``).

    Null and empty texts have no tokens.  Texts are counted whole, whatever
    their length; special strings in them count as the special tokens.  Equal
    texts get equal results, rows and other columns stay as they are, and
    columns with one of the new names are replaced.
    """
    ship(spark)

    @F.pandas_udf(_RESULT)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        prefixes = counter(tokenizer)
        for texts in batches:
            rows = []
            for t in texts:
                table = prefixes.table(t)
                rows.append((int(table[-1]), longest_within(table, budget), pack(table) if store else None))
            yield pd.DataFrame(rows, columns=["n_tokens", "fit_chars", "prefix_tokens"])

    at = free_name(docs, "_told")
    told = docs.withColumn(at, count(F.col(text)))
    new = ["n_tokens", "fit_chars", *(["prefix_tokens"] if store else [])]
    return told.withColumns({c: F.col(at)[c] for c in new}).drop(at)



def prefix_within(spark: SparkSession, counted: DataFrame, budget: int, name: str = "fit_chars") -> DataFrame:
    """Lengths of the longest prefixes within another budget, from the stored tables."""
    ship(spark)

    @F.pandas_udf("long")
    def longest(packed: pd.Series) -> pd.Series:
        return pd.Series([longest_within(unpack(p), budget) for p in packed], dtype="int64")

    return counted.withColumn(name, longest(F.col("prefix_tokens")))
