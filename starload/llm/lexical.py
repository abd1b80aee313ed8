"""Ranked lexical search of query items over all documents.

Documents are read once for a block of items.  Tasks cut them into blocks of a
few thousand and keep for each term that an item asks for a bitmap of the
documents holding it, and its occurrences there.  From the same table come the
counts that the weights need: documents, terms, and documents of each term.

Then each block ranks its documents for each item.  The bitmaps of the item's
terms, turned by bit operations, give every document the mask of terms that it
matches; documents of one mask are a group, and the largest contribution of
each term in the block bounds what a mask can score.  Groups are evaluated by
descending bound until the next bound is below the worst score that a task
still keeps: what is left cannot be ranked.  A task keeps the best documents of
each item over all of its blocks, so later blocks finish sooner.  What the tasks
keep meets in a ranking window by item.

Scores are integers but for the weight's logarithm::

    weight(df) = floor(1000 * ln((2 N + 2) / (2 df + 1)))
    m(n)       = 100 - 75 + (75 n N) div L
    score      = sum over the item's terms, repeats included, of
                 weight * ((10**9 tf) div (1000 tf + 8 m))
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.llm.common import discard, materialize, rows_of, ship

#: Documents in a block; a multiple of 8, as bitmaps are bytes.
BLOCK = 4096

#: Postings of a block at which it is closed before it has as many documents.
POSTINGS = 2_000_000

#: Terms of the items that are looked for in one reading of the documents.
TERMS = 1_000_000

#: Bytes of a text that are split into terms at once.
PIECE = 4 << 20

#: Bits of a mask table (documents by terms) that are held at once.
BITS = 1 << 24

#: Documents whose groups are evaluated together, at first; later twice as many each time.
FIRST = 64

#: ASCII letters in lower case, digits and all bytes of other characters; blanks for all else.
_TERM = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))

_BLOCKS = ("with_terms long, all_terms long, ids array<long>, lengths array<long>, terms array<int>, "
           "dfs array<long>, bitmaps array<binary>, tfs array<binary>")
_TOP = "item int, item_id long, doc_id long, score long"


def pieces(data: bytes) -> Iterator[bytes]:
    """A text in stretches that end where a term ends."""
    at = 0
    while len(data) - at > PIECE:
        cut = at + PIECE
        while cut < len(data) and _TERM[data[cut]] != 32:
            cut += 1
        yield data[at:cut]
        at = cut
    yield data[at:]


def terms(data: bytes) -> list[bytes]:
    return data.translate(_TERM).split()


def _counts(data: bytes, wanted: dict[bytes, int]) -> tuple[int, dict[int, int]]:
    """Number of terms of a text, and the occurrences of each wanted one."""
    total, found = 0, {}
    for piece in pieces(data):
        words = terms(piece)
        total += len(words)
        seen = Counter(words)
        for word in seen.keys() & wanted.keys():
            found[wanted[word]] = found.get(wanted[word], 0) + seen[word]
    return total, found


class _Block:
    """Documents of a block while it is filled; documents without a wanted term only count."""

    def __init__(self):
        self.documents = self.terms = self.size = 0
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.postings: dict[int, tuple[list[int], list[int]]] = {}

    def add(self, doc: int | None, total: int, found: dict[int, int]) -> None:
        self.documents += total > 0
        self.terms += total
        if found:
            for term, n in found.items():
                at, tf = self.postings.setdefault(term, ([], []))
                at.append(len(self.ids))
                tf.append(n)
            self.ids.append(doc)
            self.lengths.append(total)
            self.size += len(found)

    def full(self) -> bool:
        return len(self.ids) >= BLOCK or self.size >= POSTINGS

    def row(self) -> pa.RecordBatch:
        bitmaps, tfs, order = [], [], sorted(self.postings)
        for term in order:
            at, tf = self.postings[term]
            bits = np.zeros(len(self.ids), np.uint8)
            bits[at] = 1
            bitmaps.append(np.packbits(bits).tobytes())
            tfs.append(np.array(tf, np.int32).tobytes())
        values = [
            (self.documents, pa.int64()), (self.terms, pa.int64()), (self.ids, pa.list_(pa.int64())),
            (self.lengths, pa.list_(pa.int64())), (order, pa.list_(pa.int32())),
            ([len(self.postings[t][0]) for t in order], pa.list_(pa.int64())),
            (bitmaps, pa.list_(pa.binary())), (tfs, pa.list_(pa.binary())),
        ]
        names = [f.split()[0] for f in _BLOCKS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in values], names)


def _indexer(wanted: dict[bytes, int]):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            for doc, data in rows_of(batch):
                block.add(doc, *_counts(data or b"", wanted))
                if block.full():
                    yield block.row()
                    block = _Block()
        yield block.row()

    return index


class Best:
    """The best ``top`` documents so far: by score, then by identifier, null last."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)
        self.unnamed = np.zeros(0, bool)

    def bar(self) -> int:
        """No document with a smaller score will be kept."""
        return max(1, int(self.scores[-1])) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray) -> None:
        good = scores >= self.bar()
        scores = np.concatenate((self.scores, scores[good]))
        ids = np.concatenate((self.ids, ids[good]))
        unnamed = np.concatenate((self.unnamed, unnamed[good]))
        order = np.lexsort((ids, unnamed, -scores))[: self.top]
        self.scores, self.ids, self.unnamed = scores[order], ids[order], unnamed[order]


def rank_block(best: Best, bitmaps: np.ndarray, postings: list[tuple[np.ndarray, np.ndarray]],
               ids: np.ndarray, unnamed: np.ndarray) -> int:
    """Adds a block's documents to ``best`` and returns how many it evaluated.

    ``bitmaps`` has a row of bits for each term of the item, ``postings`` the
    term's documents, ascending, and what each of them gets for it.
    """
    most = np.array([gain.max() for _, gain in postings], np.int64)
    seen, step = 0, max(8, BITS // len(postings) // 8 * 8)
    for low in range(0, len(ids), step):
        part = bitmaps[:, low // 8 : (low + step) // 8]
        held = np.unpackbits(part, axis=1)[:, : len(ids) - low]
        masks = np.ascontiguousarray(np.packbits(held, axis=0).T)
        # equal masks next to each other: a group each
        order = np.lexsort(masks.T[::-1])
        first = np.flatnonzero(np.concatenate(([True], (masks[order[1:]] != masks[order[:-1]]).any(axis=1))))
        bound = held[:, order[first]].T.astype(np.int64) @ most
        ends = np.append(first[1:], len(order))
        queue = np.argsort(-bound, kind="stable")
        size, at = FIRST, 0
        while at < len(queue) and bound[queue[at]] >= best.bar():
            take = int(np.searchsorted(np.cumsum((ends - first)[queue[at : at + size]]), size)) + 1
            groups = queue[at : at + take]
            groups = groups[bound[groups] >= best.bar()]
            docs = np.sort(np.concatenate([order[first[g] : ends[g]] for g in groups])) + low
            scores = np.zeros(len(docs), np.int64)
            for k, (where, gain) in enumerate(postings):
                mine = held[k, docs - low].astype(bool)
                scores[mine] += gain[np.searchsorted(where, docs[mine])]
            best.add(scores, ids[docs], unnamed[docs])
            seen += len(docs)
            at, size = at + take, 2 * size
    return seen


def _ranker(items: list[tuple[int | None, dict[int, int]]], weights: dict[int, int], n: int, total: int, top: int):
    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Best(top) for _ in items]
        for batch in batches:
            for names, lengths, present, bitmaps, tfs in rows_of(batch):
                unnamed = np.array([x is None for x in names], bool)
                ids = np.array([0 if x is None else x for x in names], np.int64)
                m = 100 - 75 + 75 * np.array(lengths, np.int64) * n // total
                index = {}
                for term, bits, tf in zip(present, bitmaps, tfs, strict=True):
                    if weights[term]:
                        bits = np.frombuffer(bits, np.uint8)
                        where = np.flatnonzero(np.unpackbits(bits)[: len(ids)])
                        tf = np.frombuffer(tf, np.int32).astype(np.int64)
                        index[term] = bits, where, weights[term] * (10**9 * tf // (1000 * tf + 8 * m[where]))
                for best, (_, asked) in zip(kept, items, strict=True):
                    mine = [(*index[t], times) for t, times in asked.items() if t in index]
                    if mine:
                        rank_block(best, np.stack([bits for bits, *_ in mine]),
                                   [(where, gain * times) for _, where, gain, times in mine], ids, unnamed)
        rows = [(k, items[k][0], None if no else int(i), int(s)) for k, best in enumerate(kept)
                for s, i, no in zip(best.scores, best.ids, best.unnamed, strict=True)]
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)],
                                         ["item", "item_id", "doc_id", "score"])

    return rank


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` best documents (``id, text``) of each item (``id, text``):
    ``item_id, rank, doc_id, score``, equal scores by ascending identifier.

    Only scores above 0 are ranked.  Terms are maximal runs of ASCII letters and
    digits and of all other characters beyond ASCII, with A to Z lower-cased; a
    null or empty text has none.  Whole texts are read, in pieces.  Every row is
    a document or an item of its own: repeated rows are ranked as often as they
    stand, and an item that stands twice is answered twice.  Documents without an
    identifier come after others of the same score; an item without one is
    answered under null.  Without items or documents there are no rows.  Other
    columns are not looked at.

    Items are taken in blocks of about ``TERMS`` terms, which the driver holds
    with the counts of their terms; documents never pass through it.
    """
    ship(spark)
    items = items.select("id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    texts = docs.select("id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // (6 * TERMS)  # a term and what follows it have some six bytes
    part = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    found = []
    for k in range(blocks):
        asked = sorted(items.where(part == k).collect(), key=lambda r: (r.id is None, r.id or 0, r.text))
        wanted: dict[bytes, int] = {}
        held = [(r.id, Counter(wanted.setdefault(w, len(wanted)) for w in terms(r.text))) for r in asked]
        if wanted:
            found.append(_answers(spark, texts, held, wanted, top).withColumn("block", F.lit(k)))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score")


def _answers(spark, texts, items, wanted, top) -> DataFrame:
    """What the tasks keep for one block of items."""
    table = materialize(spark, texts.mapInArrow(_indexer(wanted), _BLOCKS), "lexical-blocks")
    n, total = table.agg(F.sum("with_terms"), F.sum("all_terms")).first()
    if not n:
        return spark.createDataFrame([], _TOP)
    dfs = table.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).groupBy("x.terms").agg(
        F.sum("x.dfs").alias("df")).collect()  # a row for each term of the items
    weights = {r.terms: math.floor(1000 * math.log((2 * n + 2) / (2 * r.df + 1))) for r in dfs}
    columns = ["ids", "lengths", "terms", "bitmaps", "tfs"]
    kept = table.where(F.size("ids") > 0).select(columns).mapInArrow(_ranker(items, weights, n, total, top), _TOP)
    kept = materialize(spark, kept, "lexical-top")
    discard(spark, table)
    return kept
