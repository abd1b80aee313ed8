"""Benchmark decontamination with spaced seeds.

A mask names the token positions that a seed hashes; the positions between are
free, so a passage still gives a seed where tokens there were replaced.  Seeds
of all positions of all documents are looked up among the benchmark's.  A hit
fixes how document and item lie against each other, and the whole item is then
compared there token by token: substitutions cost, but do not end the match.
Items too short for a mask have one seed, their whole token sequence.

The documents are scanned once: what meets the set of the benchmark's seeds, a
broadcast of checked size, leaves the scan as narrow rows (document, position,
seed).  These meet the index, and the alignments they fix are made distinct
before anything is compared, so text that repeats itself costs a comparison
for each alignment and not for each pair of places.  Only documents with an
alignment are tokenised again.

Only native expressions are used; no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import discard, materialize, with_row

#: Token positions of the seeds.  They leave out every fourth, every third and
#: every second token, so passages with so many replaced still have seeds.
MASKS = ((0, 1, 2, 4, 5, 6), (0, 1, 3, 4, 6, 7), (0, 2, 4, 6, 8, 10))

#: Items with fewer tokens than the shortest mask spans are looked for as they are.
MIN_TOKENS = min(m[-1] for m in MASKS) + 1

#: A match: the best stretch, a point for each equal token and one off for each
#: other, reaches ``MIN_SCORE`` (or ``SHORT_SHARE`` of a shorter item), or
#: ``MIN_SHARE`` of the whole item's tokens are equal.
MIN_SCORE, SHORT_SHARE, MIN_SHARE = 13, 0.6, 0.5

#: Different seeds that a scan of the documents looks for at most, some 40 bytes
#: each in a broadcast; more seeds take more scans.
MAX_KEYS = 8_000_000

#: Blocks of scripts written without blanks, where each character is a token: Thai
#: and Lao, Myanmar, Khmer, Japanese syllables, Chinese characters.  Ranges, since
#: asking for the script of each character costs more than all else here.
ALONE = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]"


def token_hashes(text: Column) -> Column:
    """Hashes of a text's tokens: letters and digits, in lower case; in scripts
    without blanks each character by itself."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    apart = F.when(lower.rlike(ALONE), F.regexp_replace(lower, f"({ALONE})", " $1 ")).otherwise(lower)
    parts = F.split(apart, r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def _seeds(rows: DataFrame, array: str, pos: str, key: str, short: list[int], whole: bool) -> DataFrame:
    """``rows`` once for each seed, with the seed's position and key.

    ``short`` are the lengths of items that are sought as they are; ``whole``
    is set for the items, of which they are all.
    """
    every = rows.select("*", F.posexplode(array).alias(pos, "_one"))
    room = F.size(array) - F.col(pos)
    masks = [(i, mask, room > mask[-1]) for i, mask in enumerate(MASKS)]
    for n in short:
        fits = (F.size(array) == n) & (F.col(pos) == 0) if whole else room >= n
        masks.append((len(MASKS) + n, tuple(range(n)), fits))
    keys = [F.when(fits, F.xxhash64(F.lit(i), *(F.get(array, F.col(pos) + o) for o in mask)))
            for i, mask, fits in masks]
    return every.select(*rows.columns, pos, F.explode(F.array(*keys)).alias(key)).where(F.col(key).isNotNull())


def _compared(doc: str, item: str, shift: Column) -> Column:
    """``matched`` tokens and the ``score`` of the best stretch, at one alignment."""
    points = F.transform(
        F.col(item), lambda t, i: F.when(F.get(F.col(doc), i + shift) == t, 1).otherwise(-1))
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("score"), F.lit(0).alias("matched"))

    def step(acc: Column, p: Column) -> Column:
        run = F.greatest(F.lit(0), acc["run"] + p)
        return F.struct(
            run.alias("run"), F.greatest(acc["score"], run).alias("score"),
            (acc["matched"] + F.when(p > 0, 1).otherwise(0)).alias("matched"),
        )

    return F.aggregate(points, start, step)


def alignments(spark: SparkSession, rows: DataFrame, bench: DataFrame) -> DataFrame:
    """``f, r, item, shift``: how documents (``f, r, text``) and items (``item,
    t``) lie against each other where they share a seed, each alignment once."""
    lengths = bench.select(F.size("t").alias("n")).where(F.col("n") < MIN_TOKENS).distinct().collect()
    short = sorted(x.n for x in lengths)  # under MIN_TOKENS of them
    index = materialize(spark, _seeds(bench.select("item", "t"), "t", "item_pos", "key", short, True).select(
        "key", "item", "item_pos"), "seeds")
    keys = index.select("key").distinct()
    scans = max(1, -(-keys.count() // MAX_KEYS))
    hashed = rows.select("f", "r", token_hashes(F.col("text")).alias("h"))
    seeds = _seeds(hashed, "h", "pos", "key", short, False).select("f", "r", "pos", "key")
    part = F.pmod(F.xxhash64("key"), F.lit(scans))
    # at most MAX_KEYS rows, as counted above, but for the chance of the hash
    passed = [seeds.join(F.broadcast(keys.where(part == k)), "key", "left_semi") for k in range(scans)]
    hits = materialize(spark, reduce(DataFrame.unionByName, passed), "hits")
    shift = (F.col("pos") - F.col("item_pos")).alias("shift")
    found = materialize(spark, hits.join(index, "key").select("f", "r", "item", shift).distinct(), "alignments")
    discard(spark, hits)
    discard(spark, index)
    return found


def _found(spark: SparkSession, rows: DataFrame, items: DataFrame) -> DataFrame:
    """``matches`` for rows with an identity of two integers, ``f, r``."""
    bench = materialize(
        spark,
        items.select("item_id", token_hashes(F.col("text")).alias("t"))
        .where(F.size("t") > 0)
        .select(F.monotonically_increasing_id().alias("item"), "*"),
        "benchmark",
    )
    lying = alignments(spark, rows, bench)
    some = rows.join(lying.select("f", "r").distinct(), ["f", "r"], "left_semi")
    texts = materialize(spark, some.select("f", "r", "id", token_hashes(F.col("text")).alias("h")), "aligned")
    # the documents' tokens come last, and no exchange takes them along with an alignment
    both = lying.join(bench, "item").join(texts, ["f", "r"])
    n = F.col("item_tokens")
    every = both.select("id", "item_id", F.size("t").alias("item_tokens"), _compared("h", "t", F.col("shift")).alias("c"))
    enough = (F.col("c.score") >= F.least(F.lit(MIN_SCORE), F.ceil(n * SHORT_SHARE))) | (
        F.col("c.matched") >= n * MIN_SHARE)
    every = every.where(F.when(n < MIN_TOKENS, F.col("c.matched") == n).otherwise(enough))
    # one row for each alignment found; the best is combined before the exchange
    return every.groupBy("id", "item_id").agg(
        F.max(F.struct("c.matched", "c.score", "item_tokens")).alias("best")
    ).select(
        "id", "item_id", F.col("best.item_tokens").cast("long").alias("item_tokens"),
        F.col("best.matched").cast("long").alias("matched"), F.col("best.score").cast("long").alias("score"),
    )


def _identity(at: str) -> list[Column]:
    return [F.xxhash64(F.col(at)["file"]).alias("f"), F.col(at)["row"].alias("r")]


def matches(spark: SparkSession, docs: DataFrame, items: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """``id, item_id, item_tokens, matched, score`` for each document and benchmark
    item (``item_id, text``) that match.

    The best alignment counts.  Items under ``MIN_TOKENS`` tokens match where all
    of their tokens stand as they are; in scripts without blanks a token is a
    character.  Null and empty texts, and texts without a token, match nothing.
    Rows that repeat an identifier give one row with the best of their matches;
    null identifiers form one such group.  Texts are read whole; other columns are
    not read; empty tables give no rows.  ``docs`` is a written table, or is
    written to one first.
    """
    rows, at = with_row(docs)
    return _found(spark, rows.select(*_identity(at), F.col(id).alias("id"), F.col(text).alias("text")), items)


def clean(spark: SparkSession, docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of the written table ``docs`` that match no item, with all
    columns; each row is judged by itself, repeated ones too."""
    rows, at = with_row(docs)
    found = _found(spark, rows.select(*_identity(at), F.col(at).alias("id"), F.col(text).alias("text")), items)
    found = materialize(spark, found.select(F.col("id").alias(at)).distinct(), "contaminated")
    return rows.join(found, at, "left_anti").select(*docs.columns)
