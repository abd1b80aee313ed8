"""Near-duplicate documents by MinHash signatures and a multi-index Hamming join.

A signature holds ``CHUNKS * WIDTH`` symbols of 12 bits, each the end of one
minimum hash over a document's word shingles; two documents differ in a symbol
with the chance ``1 - similarity``.  If two signatures differ in at most
``MAX_DISTANCE = 2 * CHUNKS - 1`` symbols, then by the pigeonhole principle some
chunk has at most one error.  Every document is therefore indexed, for each
chunk, under the chunk without its first, second, ... symbol: the enumeration
of the errors allowed.  All pairs within the distance meet in some bucket.  At
a similarity of 0.8 a distance above the limit has a chance of 1 in 5,800.

Only connected components are asked for, so no bucket is expanded into pairs
at once.  First each member is compared with its bucket's first member, then
with another one drawn by hash, which takes in nearly all of a large group of
copies at a few comparisons a member.  Last, members of one bucket that are
in different components still are compared, each pair in one of the buckets
that it shares.  Pairs are checked on the signatures' distance, then on parity
sketches, and what is left is confirmed on the full sets.

A parity sketch of a set has ``m`` bits, and each member flips one.  Members
that two sets share flip the same bits in both, so no more bits can differ than
members do.  Sets of ``a`` and ``b`` members with a similarity of 0.8 differ in
``(a + b) / 9`` members at most: a pair whose sketches differ in more bits has a
lower similarity for certain, and no link is lost.  With four to eight bits a
member, pairs up to 0.75, which signatures cannot tell from 0.8, are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.llm.common import WordIds, discard, materialize, mix, ship, with_row
from starload.llm.components import components

CHUNKS, WIDTH = 13, 5
SYMBOLS = CHUNKS * WIDTH
BITS = 12

#: Orders by which second comparison partners are drawn.
DRAWS = 16
MAX_DISTANCE = 2 * CHUNKS - 1

#: The similarity that ``MAX_DISTANCE`` is made for.
LEAST_PERCENT = 80

#: Multipliers (odd) and offsets of the hash functions, from a counter.
_STEPS = np.arange(1, 2 * SYMBOLS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_MULTIPLY = mix(_STEPS[:SYMBOLS]) | np.uint64(1)
_OFFSET = mix(_STEPS[SYMBOLS:])
_SALT = mix(np.arange(SYMBOLS, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)).reshape(CHUNKS, WIDTH)

#: Shingles hashed at a time, to bound the memory that a long text takes.
_BLOCK = 512


class _Words(WordIds):
    """Few words: workers that wait for their next task keep them, and an executor
    holds several."""

    LIMIT = 100_000


_words = _Words()


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles; A-Z in lower case.

    With fewer words the whole sequence is one shingle; without words none.
    """
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = _words.of(words)
    size = min(k, len(ids))
    rolled = np.full(len(ids) - size + 1, size, np.uint64)
    for i in range(size):
        rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(ids) - size + 1 + i])
    return np.unique(rolled)


def signature(hashes: np.ndarray) -> np.ndarray:
    """12-bit ends of the minimum hashes."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        some = hashes[at : at + _BLOCK] ^ _OFFSET[:, None]
        some *= _MULTIPLY[:, None]
        np.minimum(least, some.min(axis=1), out=least)
    return mix(least) & np.uint64((1 << BITS) - 1)


def pack(symbols: np.ndarray) -> np.ndarray:
    """The symbols of each chunk in one integer."""
    lanes = symbols.reshape(CHUNKS, WIDTH) << (np.uint64(BITS) * np.arange(WIDTH, dtype=np.uint64))
    return np.bitwise_or.reduce(lanes, axis=1).view(np.int64)


def index_keys(packed: np.ndarray) -> np.ndarray:
    """For each chunk and each symbol left out of it, a key of the others."""
    lane = np.uint64((1 << BITS) - 1) << (np.uint64(BITS) * np.arange(WIDTH, dtype=np.uint64))
    return mix((packed.view(np.uint64)[:, None] & ~lane) ^ _SALT).ravel().view(np.int64)


def errors(a: Column, b: Column) -> list[Column]:
    """Number of symbols in which each chunk of two packed signatures differs."""
    rest = sum(((1 << (BITS - 1)) - 1) << (BITS * i) for i in range(WIDTH))
    tops = sum((1 << (BITS - 1)) << (BITS * i) for i in range(WIDTH))
    differ = [a[i].bitwiseXOR(b[i]) for i in range(CHUNKS)]
    # a lane's top bit is set by the sum if any lower bit differs
    return [F.bit_count((x.bitwiseAND(rest) + rest).bitwiseOR(x).bitwiseAND(tops)) for x in differ]


def distance(a: Column, b: Column) -> Column:
    """Number of symbols in which two packed signatures differ."""
    return reduce(Column.__add__, errors(a, b))


def first_shared(a: Column, b: Column) -> Column:
    """Place of the first key that two packed signatures share: in the first
    chunk with at most one error, the key without that error, or the first."""
    found = F.lit(None).cast("int")
    for i, wrong in reversed(list(enumerate(errors(a, b)))):
        differ = a[i].bitwiseXOR(b[i])
        at = F.lit(0)
        for lane in range(1, WIDTH):
            at = F.when(F.shiftrightunsigned(differ, BITS * lane) != 0, lane).otherwise(at)
        found = F.when(wrong <= 1, i * WIDTH + at).otherwise(found)
    return found


def parity(hashes: np.ndarray) -> np.ndarray:
    """The parity sketch of a set in 64-bit words: their number is a power of two
    and gives each member four bits or more.  The place of a member's bit is the
    end of its hash, so half of the words are the two halves of all, xor-ed."""
    bits = 64
    while bits < 4 * len(hashes):
        bits *= 2
    at = (mix(hashes) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def may_link(n_a: Column, n_b: Column, parity_a: Column, parity_b: Column, percent: int) -> Column:
    """False only for sets that cannot have a similarity of ``percent`` / 100: by
    their sizes, or by the bits in which their parity sketches differ."""
    words = F.least(F.size(parity_a), F.size(parity_b))

    def halved(x: Column) -> Column:
        both = F.zip_with(F.slice(x, 1, words), F.slice(x, words + 1, words), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(x) > words, both).otherwise(x)

    differ = F.aggregate(
        F.zip_with(halved(parity_a), halved(parity_b), lambda p, q: F.bit_count(p.bitwiseXOR(q))),
        F.lit(0).cast("long"), lambda total, n: total + n)
    sizes = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    return sizes & (differ * (100 + percent) <= (n_a + n_b) * (100 - percent))


def _set_id(hashes: np.ndarray) -> tuple[int, int]:
    """Two sums over a set's hashes, which tell sets apart (0, 0 if empty)."""
    both = hashes.sum(), mix(hashes ^ np.uint64(0xA0761D6478BD642F)).sum()
    return tuple(int(x.astype(np.int64)) for x in both)


def sketches(spark: SparkSession, docs: DataFrame, k: int) -> DataFrame:
    """``id, n_shingles, set_hi, set_lo, sig, parity`` for ``docs`` (``id, text``)."""
    ship(spark)

    @F.pandas_udf("n_shingles long, set_hi long, set_lo long, sig array<long>, parity array<long>")
    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                found = shingles(text, k)
                both = (pack(signature(found)), parity(found)) if len(found) else (None, None)
                rows.append((len(found), *_set_id(found), *both))
            yield pd.DataFrame(rows, columns=["n_shingles", "set_hi", "set_lo", "sig", "parity"])

    told = docs.select("id", sketch(F.col("text").cast("binary")).alias("s"))
    return told.select("id", "s.*")


def _buckets(spark: SparkSession, reps: DataFrame) -> DataFrame:
    """``key, slot, node, pivot`` of all buckets with more than one member; the
    slot is the key's place among a node's keys, the pivot the first member."""

    @F.pandas_udf("array<long>")
    def keys_of(sigs: pd.Series) -> pd.Series:
        return pd.Series([index_keys(np.asarray(s, np.int64)) for s in sigs])

    keys = reps.select("node", F.posexplode(keys_of("sig")).alias("slot", "key"))
    pivots = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n"))
    shared = keys.join(pivots.where("n > 1").drop("n"), "key")
    return materialize(spark, shared.select("key", "slot", "node", "pivot"), "buckets")


def _apart(spark: SparkSession, buckets: DataFrame, joined: DataFrame) -> DataFrame:
    """``key, slot, node, root`` of buckets whose members are in several components."""
    members = buckets.select("key", "slot", "node").join(joined, "node", "left")
    members = members.withColumn("root", F.coalesce("root", "node"))
    split = members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    members = members.join(split.where("lo != hi").select("key"), "key")
    return materialize(spark, members, "members")


def _texts(spark: SparkSession, docs: DataFrame, reps: DataFrame, buckets: DataFrame, k: int) -> DataFrame:
    """``node, text`` of the members of buckets.  Where rows repeat an
    identifier, the node's text is the one with the node's set."""

    # asked about both sides of the join, so that only texts that met a node are hashed
    @F.pandas_udf("boolean")
    def has_set(texts: pd.Series, his: pd.Series, los: pd.Series) -> pd.Series:
        rows = zip(texts, his, los, strict=True)
        return pd.Series([_set_id(shingles(t, k)) == (hi, lo) for t, hi, lo in rows], dtype=bool)

    wanted = reps.join(buckets.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("id").alias("_id"), "set_hi", "set_lo"
    )
    found = docs.select("id", F.col("text").cast("binary").alias("text"))
    found = found.join(wanted, F.col("id").eqNullSafe(F.col("_id")))
    found = found.where(has_set("text", "set_hi", "set_lo"))
    return materialize(spark, found.select("node", "text"), "texts")


def _confirmed(spark: SparkSession, near: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of ``near`` whose full sets are similar enough."""

    @F.pandas_udf("boolean")
    def similar(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        last, of_last = None, None
        for nodes, ones, others in batches:
            out = []
            for node, one, other in zip(nodes, ones, others, strict=True):
                if node != last:
                    last, of_last = node, shingles(one, k)
                found = shingles(other, k)
                both = len(np.intersect1d(of_last, found, assume_unique=True))
                out.append(100 * both >= percent * (len(of_last) + len(found) - both))
            yield pd.Series(out, dtype=bool)

    pairs = near.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    pairs = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    links = pairs.where(similar("a", "text_a", "text_b")).select("a", "b").distinct()
    return materialize(spark, links, "links")


def near_duplicates(
    spark: SparkSession, docs: DataFrame, k: int = 5, percent: int = 80
) -> DataFrame:
    """``id, n_shingles, component_id`` for every row of ``docs`` (``id, text``).

    Rows are linked if their sets of ``k``-word shingles have a similarity of
    ``percent`` / 100 or more; the limit of the signature distance is made for
    0.8, higher values lose less, and lower ones are refused.  ``component_id`` is the smallest identifier
    reachable over links, the row's own included.  Null and empty texts, and
    texts of white space, have no shingle and link with nothing.  Equal rows
    and equal texts share a component.  Rows that repeat an identifier link by
    their own texts; null identifiers count only where a component has no
    other.  Other columns are not read; an empty table stays empty.
    Identifiers are read as integers, or are structs, as ``with_row`` makes them.
    """
    if percent < LEAST_PERCENT:
        raise ValueError(f"the signature distance is made for {LEAST_PERCENT} percent and more")
    id_type = docs.schema["id"].dataType
    docs = docs.select(F.col("id").cast(id_type if isinstance(id_type, StructType) else "long").alias("id"), "text")
    sketch = materialize(spark, sketches(spark, docs, k), "sketches")
    # equal sets are one node
    reps = sketch.where("n_shingles > 0").groupBy("set_hi", "set_lo").agg(
        F.min("id").alias("id"), F.any_value("n_shingles").alias("n"), F.any_value("sig").alias("sig"),
        F.any_value("parity").alias("parity"),
    )
    # nodes are numbered in the order of identifiers: an original mostly comes before
    # its copies, and as the first of its buckets it is what they are compared with
    ordered = reps.repartitionByRange("id", "set_hi").sortWithinPartitions("id", "set_hi")
    reps = materialize(
        spark, ordered.select(F.monotonically_increasing_id().alias("node"), "*"), "nodes"
    )
    sets = materialize(spark, sketch.select("id", "n_shingles", "set_hi", "set_lo"), "sets")
    discard(spark, sketch)
    buckets = _buckets(spark, reps)
    texts = _texts(spark, docs, reps, buckets, k)
    sig = reps.select("node", "sig")
    sizes = reps.select("node", "n", "parity")

    def near(pairs: DataFrame) -> DataFrame:
        """Those of the pairs ``a, b`` whose signatures are within the distance
        and whose parity sketches allow a link."""
        both = pairs.distinct().join(sig.toDF("b", "sig_b"), "b").join(sig.toDF("a", "sig_a"), "a")
        close = both.where(distance(F.col("sig_a"), F.col("sig_b")) <= MAX_DISTANCE).select("a", "b")
        both = close.join(sizes.toDF("b", "n_b", "parity_b"), "b").join(sizes.toDF("a", "n_a", "parity_a"), "a")
        left = both.where(may_link(*map(F.col, ("n_a", "n_b", "parity_a", "parity_b")), percent))
        return materialize(spark, left.select("a", "b"), "near")

    def links_of(pairs: DataFrame) -> DataFrame:
        links = _confirmed(spark, pairs, texts, k, percent)
        discard(spark, pairs)
        return links

    # each member against its bucket's first
    stars = buckets.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    links = links_of(near(stars))
    joined = components(spark, links)

    # against another member, drawn by hash
    apart = _apart(spark, buckets, joined)
    discard(spark, buckets)
    discard(spark, joined)
    drawn = F.xxhash64("node", F.pmod("key", F.lit(DRAWS)))
    partner = apart.groupBy("key").agg(F.min(F.struct(drawn.alias("h"), "node", "root")).alias("p"))
    drawn_pairs = apart.join(partner, "key").where("root != p.root").select(
        F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b"))
    links = links.unionByName(links_of(near(drawn_pairs)))
    joined = components(spark, links)

    # members of a bucket that are in different components still
    still = _apart(spark, apart, joined)
    discard(spark, apart)
    members = still.join(reps.select("node", "n", "sig", "parity"), "node")
    kept = ("node", "root", "n", "sig", "parity")
    left = members.select("key", "slot", *(F.col(c).alias(f"{c}_a") for c in kept))
    right = members.select(F.col("key").alias("key_b"), *(F.col(c).alias(f"{c}_b") for c in kept))
    sigs = F.col("sig_a"), F.col("sig_b")
    cross = left.join(right, (F.col("key") == F.col("key_b")) & (F.col("root_a") < F.col("root_b"))
                      & (distance(*sigs) <= MAX_DISTANCE) & (first_shared(*sigs) == F.col("slot"))
                      & may_link(*map(F.col, ("n_a", "n_b", "parity_a", "parity_b")), percent))
    cross = cross.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    more = links_of(materialize(spark, cross, "cross"))
    if not more.isEmpty():
        discard(spark, joined)
        joined = components(spark, links.unionByName(more))

    rooted = reps.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    known = rooted.join(first, "root").select("set_hi", "set_lo", "component_id")
    known = materialize(spark, known, "components")
    for table in (texts, still, joined, links, more, reps):
        discard(spark, table)
    named = sets.where("n_shingles > 0").join(known, ["set_hi", "set_lo"])
    alone = sets.where("n_shingles = 0").withColumn("component_id", F.col("id"))
    return named.select("id", "n_shingles", "component_id").unionByName(
        alone.select("id", "n_shingles", "component_id"))


def first_of_each(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, k: int = 5) -> DataFrame:
    """One row of each component of the written table ``docs``, with all columns.

    The row with the smallest identifier stays (nulls last), of rows that repeat
    it the first in the table.
    """
    rows, at = with_row(docs)
    found = near_duplicates(
        spark, rows.select(F.col(at).alias("id"), F.col(text_col).alias("text")), k)
    order = F.struct(F.col("doc").isNull(), "doc", "id")
    named = found.join(rows.select(F.col(at).alias("id"), F.col(id_col).alias("doc")), "id")
    first = named.groupBy("component_id").agg(F.min(order).alias("first"))
    first = materialize(spark, first.select(F.col("first.id").alias(at)), "first")
    # the files' names make this table look small enough for a broadcast, which it is not
    return rows.join(first.hint("shuffle_hash"), at, "left_semi").select(*docs.columns)
