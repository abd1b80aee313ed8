"""A class-based bigram model: exchange clustering, smoothing, scoring.

A token's probability is ``P(class | previous class) * P(word | class)``.  The
classes come from exchange clustering: a word moves to the class that raises
the likelihood of the training text's class bigrams most.

The corpus is read once, into blocks: tokens as numbers into the block's own
word list, the training texts first, so a later pass reads small integers, and
lookups of counts take a row for each block and bucket of words instead of one
for each token.  Every word of the training texts is clustered.  The ``WORDS``
most frequent words are counted in each task and their classes sent to all
tasks, so that none of them makes a hot key; the counts and classes of all
others are tables that grow with the corpus and stay distributed.  Words that
training has not seen take the class most common among the others with the same
hash of their ending.  What is sent to all tasks is fixed by ``WORDS``,
``ENDINGS`` and ``CLASSES``.

A round of clustering is a pass over the blocks that counts the classes before
and after each word of one half of the words, an exchange of these counts, and
the choice of a class for each word; the halves take turns, so that two words
that attract each other do not swap places for ever.  The classes of the words
beyond the most frequent ones then go to the blocks that have them.  Whatever is
said of many words at once is packed into binary columns, which Spark moves as
they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import cached_property, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import discard, materialize, rows_of, ship

WORDS, ENDINGS, CLASSES, ROUNDS = 16_384, 2_048, 64, 8

#: Tokens in a block, a row of about a megabyte; a longer text is a block of its own.
BLOCK_TOKENS = 250_000

#: Places of frequent words that are counted at once.
COUNT_AT_ONCE = 2_000_000

#: Bytes of a word's ending, and the weight of the class frequencies in the
#: smoothed transitions.
ENDING_BYTES, PRIOR = 3, 20.0

#: The end of a text, as a word that no text has.
END = int(np.uint64(xxhash.xxh3_64_intdigest(b" ")).astype(np.int64))

#: Counts of a unit: classes after it, classes before it, itself after itself.
WIDE = 2 * CLASSES + 1

#: Words are exchanged in buckets of the range of their hashes: at least
#: ``2 ** BUCKET_BITS``, and as many more as leave some ``BUCKET_ROWS`` counts of
#: a word in a block in each.
BUCKET_BITS, BUCKET_ROWS = 8, 200_000

#: Frequent words whose counts are exchanged in one row.
CHUNK = 128

#: Counts up to this one have their gains in a table.
SMALL = 32

#: Rows of a batch that are Python values at once.
SLICE = 256

#: Words, and cells of their counts, for which gains are held at once: as many as
#: a processor's cache holds.
BATCH_WORDS, BATCH_CELLS = 1024, 4096

# --- blocks ------------------------------------------------------------------

_BLOCK = ("block long, ids array<long>, held array<boolean>, sizes array<int>, tokens binary, "
          "rest binary, words binary, endings binary, trained binary, n_words long")
_ARROW = pa.schema([
    ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
    ("sizes", pa.list_(pa.int32())), *((name, pa.binary()) for name in ("tokens", "rest", "words", "endings", "trained")),
    ("n_words", pa.int64()),
])


#: A block is a row of a megabyte or more that packing has compressed: each is a page
#: of its own, as it is, and few are read or handed to Python at once.
_STORED = {"compression": "none", "parquet.enable.dictionary": "false", "parquet.page.size.row.check.min": "1"}
_HANDED = {"spark.sql.parquet.columnarReaderBatchSize": "4", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@contextmanager
def _large_rows(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in _HANDED}
    try:
        for name, value in _HANDED.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class _Numbers(dict):
    """Numbers words in the order of their first look-up."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = len(self)
        return value


class _Endings(dict):
    """The number of each word's ending, remembered up to a number of endings."""

    LIMIT = 100_000

    def __missing__(self, ending: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[ending] = xxhash.xxh32_intdigest(ending) % ENDINGS
        return value


_endings = _Endings()


def _packed(numbers: np.ndarray, kind: str) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.astype(kind).tobytes())


def _unpacked(packed: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


def _kind(n: int) -> str:
    """Of places in a list of ``n`` words."""
    return "<u2" if n <= 1 << 16 else "<i4"


def _block(number: int, rows: list[tuple[int | None, bool, np.ndarray]], numbers: dict[bytes, int]) -> pa.RecordBatch:
    """``tokens`` of the training texts, then the ``rest``; the words are sorted."""
    rows = sorted(rows, key=lambda row: row[1])
    words = list(numbers)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)
    ids, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    endings = np.fromiter((_endings[w[-ENDING_BYTES:]] for w in words), np.int64, len(words))[first]
    kind = _kind(len(ids))
    tokens = place[np.concatenate([text for _, _, text in rows])]
    end = sum(len(text) for _, held, text in rows if not held)
    columns = [
        [number], [[i for i, _, _ in rows]], [[held for _, held, _ in rows]], [[len(text) for _, _, text in rows]],
        [_packed(tokens[:end], kind)], [_packed(tokens[end:], kind)], [ids.astype("<i8").tobytes()],
        [endings.astype("<u2").tobytes()], [_packed(np.bincount(tokens[:end], minlength=len(ids)), "<i4")],
        [len(ids)],
    ]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def blocks(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (``id, held, text`` as bytes) in blocks."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows, size, numbers = TaskContext.get().partitionId() << 32, [], 0, _Numbers()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                for i, held, text in rows_of(batch.slice(start, SLICE)):
                    text = (text or b"").lower().split()
                    if rows and size + len(text) + 1 > BLOCK_TOKENS:
                        yield _block(number, rows, numbers)
                        number, rows, size, numbers = number + 1, [], 0, _Numbers()
                    text.append(b" ")
                    rows.append((i, held, np.fromiter(map(numbers.__getitem__, text), np.int32, len(text))))
                    size += len(text)
        if rows:
            yield _block(number, rows, numbers)

    return docs.select("id", "held", "text").mapInArrow(gather, _BLOCK)


def _with_blocks(corpus: DataFrame, columns: list[str], parts: list[DataFrame], given: list[str]) -> DataFrame:
    """``columns`` of each block in a row after the rows of ``parts`` (``block``
    and ``given``) that are for it."""
    missing = lambda table, names: [F.lit(None).cast(table.schema[n].dataType).alias(n) for n in names]
    rows = corpus.select("block", F.lit(1).alias("whole"), *columns, *[F.lit(None).cast("binary").alias(n) for n in given])
    for part in parts:
        rows = rows.unionByName(part.where("block IS NOT NULL").select(
            "block", F.lit(0).alias("whole"), *missing(corpus, columns), *given))
    return rows.repartition("block").sortWithinPartitions("block", "whole").drop("block")


# --- words in buckets --------------------------------------------------------

_WORDS_OF = "bucket long, block long, at long, words binary, endings binary, trained binary, classes binary"


def _buckets(words: np.ndarray, bits: int) -> np.ndarray:
    """Buckets from 0 on, in the order of the (signed) hashes."""
    return (words >> np.int64(64 - bits)) + (1 << (bits - 1))


def _by_bucket(corpus: DataFrame, bits: int) -> DataFrame:
    """The words of each block in a row for each bucket, from place ``at`` on."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *packed in zip(*batch.columns, strict=True):
                words, endings, trained = (x.as_py() for x in packed)
                trained = _unpacked(trained, "<i4").tobytes()
                buckets, at = np.unique(_buckets(np.frombuffer(words, "<i8"), bits), return_index=True)
                at = [*at.tolist(), len(words) // 8]
                pieces = [
                    [x[size * i : size * j] for i, j in zip(at, at[1:], strict=False)]
                    for x, size in ((words, 8), (endings, 2), (trained, 4))
                ]
                yield pa.record_batch([
                    pa.array(buckets), pa.array([block.as_py()] * len(buckets), pa.int64()), pa.array(at[:-1], pa.int64()),
                    *(pa.array(x, pa.binary()) for x in pieces), pa.nulls(len(buckets), pa.binary()),
                ], ["bucket", "block", "at", "words", "endings", "trained", "classes"])

    return corpus.select("block", "words", "endings", "trained").mapInArrow(cut, _WORDS_OF)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Each bucket with all its rows, which follow one another."""
    now, held = None, []
    for batch in batches:
        for bucket, *row in rows_of(batch):
            if held and bucket != now:
                yield now, held
                held = []
            now = bucket
            held.append(row)
    if held:
        yield now, held


def _joined(parts: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(parts), kind)


def _frequent(spark: SparkSession, corpus: DataFrame, bits: int) -> list[tuple[int, int]]:
    """The ``WORDS`` most frequent words of the training texts and their counts."""
    most = WORDS

    def top(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((words, -n))[:most]
        return words[order], n[order]

    def leading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for _, rows in _groups(batches):
            parts, trained = zip(*rows, strict=True)
            some, group = np.unique(_joined(parts, "<i8"), return_inverse=True)
            count = np.bincount(group, weights=_joined(trained, "<i4")).astype(np.int64)
            there = (count > 0) & (some != END)
            words, n = np.concatenate((words, some[there])), np.concatenate((n, count[there]))
            if len(words) > 8 * most:
                words, n = top(words, n)
        words, n = top(words, n)
        yield pa.record_batch([pa.array(words), pa.array(n)], ["word", "n"])

    placed = _by_bucket(corpus, bits).select("bucket", "words", "trained").repartition("bucket").sortWithinPartitions("bucket")
    found = placed.mapInArrow(leading, "word long, n long").orderBy(F.desc("n"), "word").limit(most)
    # written first: the driver gets these words alone, not those of each task
    return [(r.word, r.n) for r in materialize(spark, found, "frequent").collect()]


# --- units and classes -------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Frequent words (sorted hashes) and the class of each unit: these words,
    the endings of unseen words, and the end of a text.  After training also the
    counts of class pairs, the distinct words of each class, and all training
    tokens and words."""

    words: np.ndarray
    classes: np.ndarray
    pairs: np.ndarray | None = None
    types: np.ndarray | None = None
    n_tokens: int = 0
    n_words: int = 0

    def units(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        """The units of words, which are sorted."""
        n = len(self.words)
        units = n + endings.astype(np.int64)
        for sought, unit in ((self.words, np.arange(n)), (np.array([END]), np.array([n + ENDINGS]))):
            at = np.searchsorted(words, sought)
            there = np.flatnonzero(at < len(words))
            there = there[words[at[there]] == sought[there]]
            units[at[there]] = unit[there]
        return units

    def transitions(self) -> np.ndarray:
        """log10 of the smoothed probabilities of a class after a class."""
        after = self.pairs.sum(axis=0) + 0.5
        share = after / after.sum()
        rows = self.pairs + PRIOR * share
        return np.log10(rows / rows.sum(axis=1, keepdims=True))

    def word_totals(self) -> np.ndarray:
        """What a word's count plus 0.5 is divided by in its class: the class's
        tokens, and a half for each of its words and for one unseen word."""
        return self.pairs.sum(axis=0) + 0.5 * (self.types + 1)


def _start(frequent: list[tuple[int, int]]) -> Model:
    """Classes dealt out in turn, the most frequent words first; class 0 is the end's."""
    words = np.array(sorted(w for w, _ in frequent), np.int64)
    classes = np.zeros(len(words) + ENDINGS + 1, np.int64)
    for i, (word, _) in enumerate(sorted(frequent, key=lambda x: (-x[1], x[0]))):
        classes[np.searchsorted(words, word)] = 1 + i % (CLASSES - 1)
    classes[len(words) : -1] = 1 + np.arange(ENDINGS) % (CLASSES - 1)
    return Model(words, classes)


def _dealt(endings: np.ndarray) -> np.ndarray:
    """Classes that the words beyond the frequent ones start with."""
    return 1 + endings.astype(np.int64) % (CLASSES - 1)


_COUNTS = ("bucket long, block long, words binary, own binary, places binary, sizes binary, "
           "cells binary, n binary, pairs binary")
_COUNTS_ARROW = pa.schema([
    ("bucket", pa.int64()), ("block", pa.int64()),
    *((name, pa.binary()) for name in ("words", "own", "places", "sizes", "cells", "n", "pairs")),
])


def _counts(columns: dict[str, list]) -> pa.RecordBatch:
    k = len(next(iter(columns.values())))
    return pa.record_batch(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(k, f.type) for f in _COUNTS_ARROW],
        schema=_COUNTS_ARROW)


def _tail_rows(block: int, words: np.ndarray, classes: np.ndarray, cells: np.ndarray, bits: int) -> pa.RecordBatch:
    """Counts of a block's words, a row for each bucket; ``cells`` are
    ``place * WIDE + cell``, the words are sorted."""
    cells.sort()
    firsts = np.flatnonzero(np.diff(cells, prepend=-1))
    n = np.diff(firsts, append=len(cells))
    places, cells = np.divmod(cells[firsts], WIDE)
    starts = np.flatnonzero(np.diff(places, prepend=-1))
    places, sizes = places[starts], np.diff(starts, append=len(cells))
    buckets, begins = np.unique(_buckets(words[places], bits), return_index=True)
    starts = np.append(starts, len(cells))
    columns = {"bucket": buckets, "block": np.full(len(buckets), block)}
    for name, x, kind, size, cuts in (
        ("words", words[places], "<i8", 8, np.append(begins, len(places))),
        ("own", classes[places], "u1", 1, np.append(begins, len(places))),
        ("places", places, "<i4", 4, np.append(begins, len(places))),
        ("sizes", sizes, "u1", 1, np.append(begins, len(places))),
        ("cells", cells, "u1", 1, np.append(starts[begins], len(cells))),
        ("n", n, "<u4", 4, np.append(starts[begins], len(cells))),
    ):
        packed, cuts = x.astype(kind).tobytes(), (cuts * size).tolist()
        columns[name] = [packed[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
    return _counts(columns)


def _chosen_units(n: int, half: int | None) -> np.ndarray:
    """The frequent words of one half, which are counted in this order."""
    return np.arange(n)[np.arange(n) % 2 == half] if half is not None else np.arange(0)


def _counted(
    spark: SparkSession, corpus: DataFrame, model: Model, given: list[DataFrame], half: int | None, bits: int
) -> tuple[DataFrame, np.ndarray]:
    """Counts over the training texts, of one half of the words or of none, and
    the counts of class pairs.

    The counts are of words beyond the frequent ones, by block and bucket, and
    what the tasks counted of ``CHUNK`` frequent words, under ``bucket = -1 -
    chunk``.  ``given`` has the choices made so far.
    """
    slots = np.full(len(model.classes), -1, np.int64)
    chosen = _chosen_units(len(model.words), half)
    slots[chosen] = np.arange(len(chosen))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(chosen) * WIDE, np.int64)
        pairs = np.zeros(CLASSES * CLASSES, np.int64)
        known, waiting = [], []

        def add() -> None:
            if waiting:
                np.add(total, np.bincount(np.concatenate(waiting), minlength=len(total)), out=total)
                waiting.clear()

        for batch in batches:
            for whole, number, packed, words, endings, places, found in rows_of(batch):
                if not whole:
                    known.append((places, found))
                    continue
                words, endings = np.frombuffer(words, "<i8"), np.frombuffer(endings, "<u2")
                units = model.units(words, endings)
                tail = (units >= len(model.words)) & (words != END)
                classes = np.where(tail, _dealt(endings), model.classes[units]).astype(np.int16)
                if known:
                    places, found = zip(*known, strict=True)
                    classes[_joined(places, "<i4")] = _joined(found, "u1")
                    known = []
                now = _unpacked(packed, _kind(len(words)))
                d = classes[now]
                # what stands before a text is the end of the one before it
                c = np.concatenate((d[:0], np.zeros(min(len(d), 1), np.int16), d[:-1]))
                pairs += np.bincount(c * np.int16(CLASSES) + d, minlength=len(pairs))
                if half is None or not len(now):
                    continue
                slot = slots[units]
                slot[tail] = -1
                tail &= (words & 1) == half
                again = np.flatnonzero(now[1:] == now[:-1])
                at = slot[now]
                some = np.flatnonzero(at >= 0)
                waiting.append(at[some] * WIDE + CLASSES + c[some])
                # the last token is an end, which is none of the counted words
                waiting.append(at[some] * WIDE + d[some + 1])
                some = at[again]
                waiting.append(some[some >= 0] * WIDE + 2 * CLASSES)
                if sum(map(len, waiting)) > COUNT_AT_ONCE:
                    add()
                some = np.flatnonzero(tail[now])
                rare = now.astype(np.int64)
                again = again[tail[now[again]]]
                yield _tail_rows(number, words, classes, np.concatenate((
                    rare[some] * WIDE + d[some + 1], rare[some] * WIDE + CLASSES + c[some],
                    rare[again] * WIDE + 2 * CLASSES)), bits)
        add()
        chunks = [total[i : i + CHUNK * WIDE] for i in range(0, len(total), CHUNK * WIDE)]
        some = [i for i, x in enumerate(chunks) if x.any()]
        yield _counts({
            "bucket": [*(-1 - i for i in some), None], "cells": [*(_packed(chunks[i], "<i8") for i in some), None],
            "pairs": [*[None] * len(some), pairs.astype("<i8").tobytes()]})

    columns = ["number", "tokens", "words", "endings"]
    rows = _with_blocks(corpus.withColumn("number", F.col("block")), columns, given, ["places", "classes"])
    found = materialize(spark, rows.mapInArrow(count, _COUNTS), "counts")
    return found, _pairs(found)


def _pairs(found: DataFrame) -> np.ndarray:
    """Counts of class pairs: a row for each class."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for (packed,) in rows_of(batch):
                total += np.frombuffer(packed, "<i8")
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["pair", "n"])

    pairs = np.zeros(CLASSES * CLASSES)
    sums = found.select("pairs").where("pairs IS NOT NULL").mapInArrow(add, "pair long, n long")
    for row in sums.groupBy("pair").agg(F.sum("n").alias("n")).collect():
        pairs[row.pair] = row.n
    return pairs.reshape(CLASSES, CLASSES)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


class Pairs:
    """Counts of class pairs with what the choices of a task derive from them."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts

    @cached_property
    def f(self) -> np.ndarray:
        return _f(self.counts)

    @cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What ``f`` of the pair counts of a second (first) class gains by 1 to ``SMALL``."""
        steps = np.arange(1, SMALL + 1)[:, None, None]
        return _f(self.counts.T + steps) - self.f.T, _f(self.counts + steps) - self.f


def best_class(counts: np.ndarray, own: int, pairs: np.ndarray | Pairs) -> int:
    """The class in which a unit makes the class bigrams most likely.

    The log likelihood is the sum of ``f(pair counts)`` less that of ``f`` of
    the counts of first and of second classes, with ``f(x) = x log x``.  The
    unit is taken out of its class and put into each in turn.
    """
    pairs = pairs if isinstance(pairs, Pairs) else Pairs(pairs)
    after, before, twice = counts[:CLASSES].astype(float), counts[CLASSES:-1].astype(float), float(counts[-1])
    m = pairs.counts.copy()
    m[own] -= after
    m[:, own] -= before
    m[own, own] += twice
    first, second = m.sum(axis=1), m.sum(axis=0)
    n_after, n_before = after.sum(), before.sum()
    after[own] -= twice
    before[own] -= twice
    old = pairs.f.copy()
    old[own], old[:, own] = _f(m[own]), _f(m[:, own])
    rows = _f(m + after) - old
    columns = _f(m + before[:, None]) - old
    both = _f(np.diag(m) + after + before + twice) - np.diag(old)
    gain = rows.sum(axis=1) - np.diag(rows) + columns.sum(axis=0) - np.diag(columns) + both
    gain -= _f(first + n_after) - _f(first) + _f(second + n_before) - _f(second)
    gain[0] = -np.inf
    best = int(np.argmax(gain))
    return best if gain[best] > gain[own] + 1e-6 else own


def _gains(rows: np.ndarray, cells: np.ndarray, n: np.ndarray, own: np.ndarray, other: np.ndarray,
           twice: np.ndarray, pairs: np.ndarray, f: np.ndarray, table: np.ndarray) -> np.ndarray:
    """For each row and class, what the sum of ``f`` over that class's row of
    ``pairs`` gains by the row's counts ``n`` of classes ``cells``, but for the
    class with itself.  ``other`` are the counts against the direction; ``f`` and
    ``table`` are of ``pairs``."""
    total = np.zeros((len(own), CLASSES))
    turned, turned_f = np.ascontiguousarray(pairs.T), np.ascontiguousarray(f.T)
    for start in range(0, len(rows), BATCH_CELLS):
        r, d, x = (a[start : start + BATCH_CELLS] for a in (rows, cells, n))
        o, at = own[r], np.arange(len(r))
        added = np.where(d == o, x - twice[r], x)
        gain = table[np.minimum(added, SMALL).astype(np.int64) - 1, d]
        # the row's own class, which the counts were taken from
        had = pairs[o, d]
        gain[at, o] = _f(had - x + added) - _f(had - x)
        large = np.flatnonzero((added > SMALL) & (d != o))
        m = turned[d[large]]
        m += added[large, None]
        kept = gain[large, o[large]]
        gain[large] = _f(m) - turned_f[d[large]]
        gain[large, o[large]] = kept
        self_ = np.flatnonzero(d == o)
        m = turned[d[self_]]
        m -= other[r[self_]]
        gain[self_] = _f(m + added[self_, None]) - _f(m)
        gain[at, d] = 0.0
        starts = np.flatnonzero(np.diff(r, prepend=-1))
        total[r[starts]] += np.add.reduceat(gain, starts, axis=0)
    return total


def best_classes(rows: np.ndarray, cells: np.ndarray, n: np.ndarray, own: np.ndarray,
                 pairs: np.ndarray | Pairs) -> np.ndarray:
    """``best_class`` of many words: ``n`` times ``cells`` of the words ``rows``
    (sorted, each cell once), whose classes are ``own``."""
    pairs = pairs if isinstance(pairs, Pairs) else Pairs(pairs)
    found = []
    for start in range(0, len(own), BATCH_WORDS):
        part = slice(*np.searchsorted(rows, (start, start + BATCH_WORDS)))
        found.append(_best_classes(rows[part] - start, cells[part], n[part], own[start : start + BATCH_WORDS], pairs))
    return np.concatenate(found)


def _best_classes(rows: np.ndarray, cells: np.ndarray, n: np.ndarray, own: np.ndarray, known: Pairs) -> np.ndarray:
    k, pairs = len(own), known.counts
    wide = np.zeros((k, WIDE))
    wide[rows, cells] = n
    after, before, twice = wide[:, :CLASSES], wide[:, CLASSES:-1], wide[:, -1]
    at, n_after, n_before = np.arange(k), after.sum(axis=1), before.sum(axis=1)
    first, second = pairs.sum(axis=1) - before, pairs.sum(axis=0) - after
    first[at, own] -= n_after - twice
    second[at, own] -= n_before - twice
    diagonal = np.tile(np.diag(pairs), (k, 1))
    diagonal[at, own] += twice - after[at, own] - before[at, own]
    forth = cells < CLASSES
    back = (cells >= CLASSES) & (cells < 2 * CLASSES)
    gain = _gains(rows[forth], cells[forth], n[forth], own, before, twice, pairs, known.f, known.tables[0])
    gain += _gains(rows[back], cells[back] - CLASSES, n[back], own, after, twice, pairs.T, known.f.T, known.tables[1])
    both = after + before + twice[:, None]
    both[at, own] -= 2 * twice
    gain += _f(diagonal + both) - _f(diagonal)
    gain -= _f(first + n_after[:, None]) - _f(first) + _f(second + n_before[:, None]) - _f(second)
    gain[:, 0] = -np.inf
    best = np.argmax(gain, axis=1)
    return np.where(gain[at, best] > gain[at, own] + 1e-6, best, own)


_CHOICES = "bucket long, block long, places binary, words binary, classes binary"


def _decided(bucket: int, rows: list[tuple], pairs: Pairs) -> pa.RecordBatch:
    """Choices from all rows of a bucket: ``places`` and ``classes`` for each of
    its blocks, and ``words`` (each once) and their classes without a block."""
    blocks, words, own, places, sizes, cells, n = zip(*rows, strict=True)
    every, first, group = np.unique(_joined(words, "<i8"), return_index=True, return_inverse=True)
    keys = np.repeat(group, _joined(sizes, "u1")) * 256 + _joined(cells, "u1")
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    firsts = np.flatnonzero(np.diff(keys, prepend=-1))
    keys, total = keys[firsts], np.add.reduceat(_joined(n, "<u4")[order], firsts, dtype=np.float64)
    classes = best_classes(keys // 256, keys % 256, total, _joined(own, "u1")[first].astype(np.int64), pairs).astype("u1")
    ends = np.cumsum([0, *map(len, own)]).tolist()
    found = classes[group].tobytes()
    k = len(blocks)
    return pa.record_batch([
        pa.array([bucket] * (k + 1), pa.int64()), pa.array([*blocks, None], pa.int64()),
        pa.array([*places, None], pa.binary()), pa.array([*[None] * k, every.astype("<i8").tobytes()], pa.binary()),
        pa.array([*(found[i:j] for i, j in zip(ends, ends[1:], strict=False)), classes.tobytes()], pa.binary()),
    ], ["bucket", "block", "places", "words", "classes"])


def _moved(bucket: int, total: np.ndarray, chosen: np.ndarray, model: Model, pairs: Pairs) -> pa.RecordBatch:
    """Choices of a chunk of the frequent words: their units in ``places``."""
    total = total.reshape(-1, WIDE)
    first = (-1 - bucket) * CHUNK
    some = np.flatnonzero(total.any(axis=1))
    units = chosen[first + some]
    classes = [best_class(total[i], int(model.classes[u]), pairs) for i, u in zip(some, units, strict=True)]
    return pa.record_batch([
        pa.array([bucket], pa.int64()), pa.nulls(1, pa.int64()), pa.array([units.astype("<i4").tobytes()], pa.binary()),
        pa.nulls(1, pa.binary()), pa.array([np.array(classes, "u1").tobytes()], pa.binary()),
    ], ["bucket", "block", "places", "words", "classes"])


def _choices(spark: SparkSession, counts: DataFrame, counted: np.ndarray, model: Model, half: int) -> DataFrame:
    """The classes that the counted words choose, see ``_decided`` and ``_moved``."""
    chosen = _chosen_units(len(model.words), half)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Pairs(counted)
        now, held, total = None, [], None
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                for bucket, *row in rows_of(batch.slice(start, SLICE)):
                    if now is not None and bucket != now:
                        yield _decided(now, held, pairs) if now >= 0 else _moved(now, total, chosen, model, pairs)
                        held, total = [], None
                    now = bucket
                    if bucket >= 0:
                        held.append(row)
                    else:
                        part = _unpacked(row[5], "<i8")
                        total = part if total is None else total + part
        if now is not None:
            yield _decided(now, held, pairs) if now >= 0 else _moved(now, total, chosen, model, pairs)

    rows = counts.where("bucket IS NOT NULL").drop("pairs")
    placed = rows.repartition("bucket").sortWithinPartitions("bucket")
    return materialize(spark, placed.mapInArrow(choose, _CHOICES), "choices")


def cluster(spark: SparkSession, corpus: DataFrame, model: Model, bits: int) -> tuple[Model, list[DataFrame]]:
    """Exchange clustering of all training words.

    The result has the pair counts of its classes; with it come the last choices
    of both halves: ``words`` and ``classes`` in rows without a block are all
    words but the frequent ones, each once."""
    choices: list[DataFrame] = []
    for turn in range(ROUNDS):
        half = turn % 2
        found, pairs = _counted(spark, corpus, model, choices, half, bits)
        choices.append(_choices(spark, found, pairs, model, half))
        classes = model.classes.copy()
        for row in choices[-1].where("bucket < 0").select("places", "classes").collect():
            classes[np.frombuffer(row.places, "<i4")] = np.frombuffer(row.classes, "u1")
        model = replace(model, classes=classes)
        discard(spark, found)
        if len(choices) > 2:  # those that this half made before
            discard(spark, choices.pop(0))
    found, pairs = _counted(spark, corpus, model, choices, None, bits)
    discard(spark, found)
    return replace(model, pairs=pairs), choices


# --- model and scores --------------------------------------------------------

#: Sums over the training words: the words beyond the frequent ones by ending
#: and class, all words by class, all tokens.
_TAIL, _TYPES, _TOKENS = 0, ENDINGS * CLASSES, ENDINGS * CLASSES + CLASSES

_KNOWN = "block long, at binary, counts binary, classes binary, sums array<long>"


def _known(spark: SparkSession, corpus: DataFrame, model: Model, choices: list[DataFrame], bits: int) -> DataFrame:
    """Training counts and classes of the words of each block from place ``at``
    on, and a row of ``sums`` from each task: numbers of sums, then the sums."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(_TOKENS + 1, np.int64)
        for _, rows in _groups(batches):
            here = [row for row in rows if row[0] is not None]
            if not here:
                continue
            blocks, at, words, endings, trained, _ = zip(*here, strict=True)
            every, first, group = np.unique(_joined(words, "<i8"), return_index=True, return_inverse=True)
            endings = _joined(endings, "<u2")[first]
            count = np.bincount(group, weights=_joined(trained, "<i4")).astype(np.int64)
            units = model.units(every, endings)
            classes = model.classes[units]
            for row in rows:
                if row[0] is None:
                    classes[np.searchsorted(every, np.frombuffer(row[2], "<i8"))] = np.frombuffer(row[5], "u1")
            seen = count > 0
            tail = seen & (units >= len(model.words)) & (every != END)
            sums[:_TYPES] += np.bincount(endings[tail].astype(np.int64) * CLASSES + classes[tail], minlength=_TYPES)
            sums[_TYPES:_TOKENS] += np.bincount(classes[seen], minlength=CLASSES)
            sums[_TOKENS] += count.sum()
            counts, found = count[group].astype("<i8").tobytes(), classes[group].astype("u1").tobytes()
            ends = np.cumsum([0, *(len(w) // 8 for w in words)]).tolist()
            cuts = list(zip(ends, ends[1:], strict=False))
            yield pa.record_batch([
                pa.array(blocks, pa.int64()), pa.array([i.to_bytes(8, "little") for i in at], pa.binary()),
                pa.array([counts[8 * i : 8 * j] for i, j in cuts], pa.binary()),
                pa.array([found[i:j] for i, j in cuts], pa.binary()), pa.nulls(len(blocks), pa.list_(pa.int64())),
            ], ["block", "at", "counts", "classes", "sums"])
        some = np.flatnonzero(sums)
        yield pa.record_batch([
            pa.nulls(1, pa.int64()), *[pa.nulls(1, pa.binary())] * 3,
            pa.array([np.concatenate((some, sums[some]))], pa.list_(pa.int64())),
        ], ["block", "at", "counts", "classes", "sums"])

    rows = _by_bucket(corpus, bits)
    for table in choices:
        rows = rows.unionByName(table.where("bucket >= 0 AND block IS NULL").select(
            "bucket", "block", F.lit(None).cast("long").alias("at"), "words",
            F.lit(None).cast("binary").alias("endings"), F.lit(None).cast("binary").alias("trained"), "classes"))
    placed = rows.repartition("bucket").sortWithinPartitions("bucket", "block")
    return materialize(spark, placed.mapInArrow(look_up, _KNOWN), "known")


def _finished(model: Model, known: DataFrame) -> Model:
    """The model with all its sums.  Endings take the class that most of their
    words beyond the frequent ones have."""
    half = F.expr("size(sums) div 2")
    each = known.where("block IS NULL").select(F.explode(F.arrays_zip(
        F.slice("sums", F.lit(1), half).alias("key"), F.slice("sums", half + 1, half).alias("n"))).alias("x"))
    sums = np.zeros(_TOKENS + 1, np.int64)
    for row in each.groupBy("x.key").agg(F.sum("x.n").alias("n")).collect():
        sums[row.key] = row.n
    tail, types = sums[:_TYPES].reshape(ENDINGS, CLASSES), sums[_TYPES:_TOKENS]
    classes = model.classes.copy()
    some = np.flatnonzero(tail.any(axis=1))
    classes[len(model.words) + some] = tail[some].argmax(axis=1)
    return replace(model, classes=classes, types=types.astype(float), n_tokens=int(sums[_TOKENS]), n_words=int(types.sum()))


def train(spark: SparkSession, corpus: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the training counts and classes of each block's words, see ``_known``."""
    places = corpus.agg(F.sum("n_words")).first()[0] or 0
    bits = max(BUCKET_BITS, (places // BUCKET_ROWS).bit_length())
    model, choices = cluster(spark, corpus, _start(_frequent(spark, corpus, bits)), bits)
    known = _known(spark, corpus, model, choices, bits)
    for table in choices:
        discard(spark, table)
    return _finished(model, known), known


_SCORES = ("id long, held boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Trains on the rows of ``docs`` (``id, held, text``) with ``held`` false
    and scores all.

    Returns ``id, held, n_tokens`` (words and one end), ``n_known`` (tokens that
    the training texts have), ``train_tokens``, ``base_score`` (log10 of the
    smoothed unigrams) and ``score`` (log10 probability of the text under the
    class model).  A-Z count as lower case.  Null, empty and blank texts are one
    end; texts are read whole; null ``held`` counts as false; rows may repeat
    and keep their own results; other columns are not read; an empty table
    stays empty, and without training rows every token is unseen.
    """
    ship(spark)
    docs = docs.select(
        F.col("id").cast("long").alias("id"),
        F.coalesce("held", F.lit(False)).alias("held"),
        F.col("text").cast("binary").alias("text"),
    )
    with _large_rows(spark):
        corpus = materialize(spark, blocks(docs), "blocks", **_STORED)
        model, known = train(spark, corpus)
        scores = materialize(spark, _scored(corpus, model, known), "scores")
        for table in (corpus, known):
            discard(spark, table)
    return scores


def _scored(corpus: DataFrame, model: Model, known: DataFrame) -> DataFrame:
    columns = ["ids", "held", "sizes", "tokens", "rest", "words", "endings"]
    whole = _with_blocks(corpus, columns, [known], ["at", "counts", "classes"])

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transitions, totals = model.transitions(), model.word_totals()
        base_total = model.n_tokens + 0.5 * (model.n_words + 1)
        found = []
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                if not row[0].as_py():
                    found.append([x.as_py() for x in row[8:]])
                    continue
                ids, held, sizes = (x.values for x in row[1:4])
                tokens, rest, words, endings = (x.as_py() for x in row[4:8])
                words, sizes = np.frombuffer(words, "<i8"), sizes.to_numpy()
                found.sort(key=lambda part: int.from_bytes(part[0], "little"))
                _, count, chosen = zip(*found, strict=True)
                found = []
                count = _joined(count, "<i8")
                unseen = model.classes[model.units(words, np.frombuffer(endings, "<u2"))]
                classes = np.where(count > 0, _joined(chosen, "u1"), unseen)
                base = np.log10((count + 0.5) / base_total)
                emitted = np.where(words == END, 0.0, np.log10((count + 0.5) / totals[classes]))
                now = np.concatenate([_unpacked(x, _kind(len(words))) for x in (tokens, rest)])
                d = classes[now]
                # what stands before a text is the end of the one before it
                each = transitions[np.concatenate(([0], d[:-1])), d] + emitted[now]
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                yield pa.record_batch([
                    ids, held, pa.array(sizes.astype(np.int64)),
                    pa.array(np.add.reduceat((count > 0)[now].astype(np.int64), starts)),
                    pa.array(np.full(len(sizes), model.n_tokens, np.int64)),
                    pa.array(np.add.reduceat(base[now], starts)), pa.array(np.add.reduceat(each, starts)),
                ], ["id", "held", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return whole.mapInArrow(scores, _SCORES)
