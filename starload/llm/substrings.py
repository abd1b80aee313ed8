"""Removal of passages that repeat across documents, found by difference-cover anchors.

A window is ``WINDOW`` consecutive words.  To find repeated windows without
hashing all of them into an exchange, documents are hashed at anchors only:
positions whose remainder modulo ``PERIOD`` lies in the difference cover
``COVER``.  Any two positions can be moved on by the same distance, less than
``PERIOD``, so that both become anchors; two equal windows therefore share an
anchor of ``ANCHOR = WINDOW - PERIOD + 1`` words that lies in both at the same
place.  Anchors that two documents share are extended: every window around one
is hashed whole, and of equal windows the smallest identifier is looked up.

No pairs of documents are formed.  Both lookups are an aggregation, combined
before its exchange, and a join back to it, which splits hot hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import WordIds, materialize, mix, ship

WINDOW = 50

#: A difference cover: every remainder modulo 31 is a difference of two of these.
PERIOD = 31
COVER = np.array([1, 5, 11, 24, 25, 27])
ANCHOR = WINDOW - PERIOD + 1

#: Base of the rolling hash, and its inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_words = WordIds()


class _Powers:
    """Powers of a base modulo 2**64, as many as the longest text needed."""

    def __init__(self, base: int):
        self.base, self.known = np.uint64(base), np.ones(1, np.uint64)

    def __call__(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            self.known = np.concatenate(
                ([np.uint64(1)], np.cumprod(np.full(max(n, 65_536), self.base, np.uint64)))
            )
        return self.known[:n]


_powers, _inverses = _Powers(_BASE), _Powers(_INVERSE)


class Rolled:
    """Hashes of any run of words of a text, by differences of a running sum."""

    def __init__(self, words: list[bytes]):
        n = len(words)
        ids = _words.of(words)
        self.n = n
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(ids * _powers(n), out=self.sums[1:])

    def at(self, starts: np.ndarray, length: int) -> np.ndarray:
        cut = (self.sums[starts + length] - self.sums[starts]) * _inverses(self.n + 1)[starts]
        return mix(cut + np.uint64(length)).view(np.int64)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Anchor positions and their hashes."""
        last = self.n - ANCHOR
        if self.n < WINDOW:  # no window, so nothing to find
            return np.empty(0, np.int64), np.empty(0, np.int64)
        grid = (np.arange(0, last + PERIOD, PERIOD)[:, None] + COVER).ravel()
        where = grid[grid <= last]
        return where, self.at(where, ANCHOR)

    def windows(self) -> np.ndarray:
        return self.at(np.arange(max(0, self.n - WINDOW + 1)), WINDOW)


def _split(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def _anchored(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``id, th, n_words, whole_sha256, anchors`` of every row."""

    @F.pandas_udf("n_words long, whole_sha256 string, anchors array<long>")
    def anchor(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                words = _split(text)
                sha = hashlib.sha256(b" ".join(words)).hexdigest()
                rows.append((len(words), sha, np.unique(Rolled(words).anchors()[1])))
            yield pd.DataFrame(rows, columns=["n_words", "whole_sha256", "anchors"])

    told = docs.select("id", "th", anchor("text").alias("a"))
    return told.select("id", "th", "a.*")


def _shared(rows: DataFrame) -> DataFrame:
    """``id, found``: hashes of ``rows`` (``id, h``) that another identifier has too."""
    ends = rows.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    both = rows.join(ends.where("lo != hi").select("h"), "h")
    return both.groupBy("id").agg(F.collect_set("h").alias("found"))


def _repeated(rows: DataFrame) -> DataFrame:
    """``id, found``: hashes of ``rows`` that a smaller identifier has too."""
    least = rows.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    both = rows.join(least.where("lo != hi").select("h", "lo"), "h").where("id > lo")
    return both.groupBy("id").agg(F.collect_set("h").alias("found"))


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Takes repeated passages out of ``docs`` (``id, text``).

    A word goes if it lies in a window whose word sequence also starts in a row
    with a smaller identifier; windows are judged on the input.  Returns for
    each row ``id, n_words, n_removed, kept_sha256`` (of the kept words, joined
    by one blank) and ``kept`` (the kept text, null where nothing was removed).

    Null and empty texts have no words; texts under ``WINDOW`` words have no
    window.  Rows that repeat an identifier do not count for each other, a null
    identifier is larger than all others.  Words are compared unchanged, by
    64-bit hashes.  Other columns are not read; an empty table stays empty.
    """
    ship(spark)
    last = (1 << 63) - 1
    docs = docs.select(
        F.coalesce(F.col("id").cast("long"), F.lit(last)).alias("id"),
        F.col("text").cast("binary").alias("text"),
    ).withColumn("th", F.xxhash64("text"))
    rows = materialize(spark, _anchored(spark, docs), "anchors")
    shared = materialize(spark, _shared(rows.select("id", F.explode("anchors").alias("h"))), "shared")

    @F.pandas_udf("array<long>")
    def around(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        """Hashes of the windows that hold a shared anchor near their start."""
        for texts, founds in batches:
            out = []
            for text, found in zip(texts, founds, strict=True):
                rolled = Rolled(_split(text))
                where, hashes = rolled.anchors()
                hits = np.zeros(rolled.n + PERIOD + 1, np.int64)
                hits[where[np.isin(hashes, found)] + 1] = 1
                upto = np.cumsum(hits)
                starts = np.arange(max(0, rolled.n - WINDOW + 1))
                starts = starts[upto[starts + PERIOD] > upto[starts]]
                out.append(np.unique(rolled.at(starts, WINDOW)))
            yield pd.Series(out)

    wide = docs.join(shared, "id").withColumn("windows", around("text", "found"))
    wide = materialize(spark, wide.drop("found"), "windows")
    found = _repeated(wide.select("id", F.explode("windows").alias("h")))
    found = materialize(spark, found, "repeated")

    @F.pandas_udf("n_removed long, kept_sha256 string, kept string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, founds in batches:
            out = []
            for text, gone in zip(texts, founds, strict=True):
                words = _split(text)
                starts = np.flatnonzero(np.isin(Rolled(words).windows(), gone))
                cover = np.zeros(len(words) + 1, np.int64)
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + WINDOW, -1)
                stays = np.cumsum(cover)[:-1] == 0
                left = b" ".join(w for w, s in zip(words, stays.tolist(), strict=True) if s)
                out.append((int((~stays).sum()), hashlib.sha256(left).hexdigest(), left.decode()))
            yield pd.DataFrame(out, columns=["n_removed", "kept_sha256", "kept"])

    done = wide.select("id", "th", "text").join(found, "id").withColumn("c", cut("text", "found"))
    done = materialize(spark, done.select("id", "th", "c.*").dropDuplicates(["id", "th"]), "cut")
    return rows.join(done, ["id", "th"], "left").select(
        F.when(F.col("id") != last, F.col("id")).alias("id"),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        "kept",
    )
