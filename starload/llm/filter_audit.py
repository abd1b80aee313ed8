"""What each order of a set of filters removes, counted in one pass.

Which filters a row fails is a mask.  For every mask there is one big integer
with a counter for each step of each order (five filters: 120 orders, 600
steps) and each kind of outcome: kept after the step, removed by it, failing it
but removed before, failing it alone, and good or toxic rows removed by it.
The integer of a mask holds 0 or 1 in each counter, so the sum of the rows'
integers holds all counts at once.

Counters are 64 bits wide: a sum of fewer than 2**63 rows never reaches the next
counter.  Tasks add the integers up by part, the sums meet in two rounds (the
first salted by the task they come from, so a part with most of the rows is
still spread out), and each part is unpacked where its last sum is made.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import WORD, materialize, rows_of, ship

KINDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

#: Sums that a task holds at a time; parts beyond that are passed on and summed later.
HELD = 1000

#: Tasks of the first round for each part.
SALTS = 16

_SUMS = "part string, packed binary"


@lru_cache(maxsize=2)
def steps(filters: str) -> list[tuple[str, int, str]]:
    """Order, step from 1 and the step's filter, in the order of the counters."""
    return [("".join(o), k + 1, x) for o in permutations(filters) for k, x in enumerate(o)]


@lru_cache(maxsize=2)
def integers(filters: str) -> list[int]:
    """The big integer of each code: failing filters in the lowest bits, then good, then toxic."""
    width, made = len(filters), []
    for code in range(1 << (width + 2)):
        fails = {x for k, x in enumerate(filters) if code >> k & 1}
        good, toxic = code >> width & 1, code >> (width + 1) & 1
        fields = np.zeros((len(KINDS), len(steps(filters))), "<u8")
        for at, (order, step, own) in enumerate(steps(filters)):
            gone = next((k + 1 for k, x in enumerate(order) if x in fails), width + 1)
            removed = gone == step
            fields[:, at] = (gone > step, removed, own in fails and gone < step, fails == {own},
                             removed and good, removed and toxic)
        made.append(int.from_bytes(fields.tobytes(), "little"))
    return made


def _size(filters: str) -> int:
    return 8 * len(KINDS) * len(steps(filters))


def unpacked(filters: str, total: int) -> np.ndarray:
    """Counts by kind and step."""
    return np.frombuffer(total.to_bytes(_size(filters), "little"), "<u8").astype(np.int64).reshape(len(KINDS), -1)


def _batch(filters: str, sums: dict[str, int]) -> pa.RecordBatch:
    data = [total.to_bytes(_size(filters), "little") for total in sums.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(data, pa.binary())], ["part", "packed"])


def _adder(filters: str, held: int):
    """Task code: rows of (part, code) to one integer a part."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, sums = integers(filters), {}
        for batch in batches:
            for (part, code), n in Counter(rows_of(batch)).items():
                sums[part] = sums.get(part, 0) + table[code] * n
                if len(sums) >= held:
                    yield _batch(filters, sums)
                    sums = {}
        yield _batch(filters, sums)

    return add


def _merger(filters: str, held: int):
    """Task code: sums of a part that come in any order to fewer of them."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, int] = {}
        for batch in batches:
            for part, data in rows_of(batch):
                sums[part] = sums.get(part, 0) + int.from_bytes(data, "little")
                if len(sums) >= held:
                    yield _batch(filters, sums)
                    sums = {}
        yield _batch(filters, sums)

    return merge


def _opener(filters: str):
    """Task code: sums sorted by part to a row for each part and step."""
    table = steps(filters)
    own = np.array([filters.index(x) for *_, x in table])
    fixed = [pa.array([s[0] for s in table]), pa.array([s[1] for s in table], pa.int32()),
             pa.array([s[2] for s in table])]

    def rows(part: str, total: int) -> pa.RecordBatch:
        counts = unpacked(filters, total)
        share = np.bincount(own, counts[1], len(filters))  # exact below 2**53 rows
        exact = [int(counts[1][own == k].sum()) for k in range(len(filters))] if share.max() >= 2**53 else share
        shapley = np.array(exact, np.int64)[own]
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(table)), *fixed, *map(pa.array, counts), pa.array(shapley)],
            ["part", "filter_order", "step", "filter", *KINDS, "shapley"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, 0
        for batch in batches:
            for part, data in rows_of(batch):
                if part != now and now is not None:
                    yield rows(now, total)
                if part != now:
                    now, total = part, 0
                total += int.from_bytes(data, "little")
        if now is not None:
            yield rows(now, total)

    return unpack


def audit(
    spark: SparkSession, rows: DataFrame, filters: Sequence[str], part: Column, fails: Sequence[Column],
    good: Column, toxic: Column,
) -> DataFrame:
    """A row for each part, order of the filters and step: ``part``,
    ``filter_order``, ``step`` (from 1), ``filter``, the counts of ``KINDS`` and
    ``shapley`` (rows that the step's filter removes, over all orders).

    ``filters`` are up to six letters, ``fails`` says for each whether a row
    fails it; ``good`` and ``toxic`` mark rows whose loss counts.  A null part
    counts as the empty string, a null condition as false.  Repeated rows count
    as often as they stand, and an empty table has no parts and no rows.
    """
    ship(spark)
    name = "".join(filters)
    if len(set(name)) != len(filters) or not 1 <= len(filters) <= 6:
        raise ValueError("one to six different letters are asked for")
    bits = [F.when(x, F.lit(1 << k)).otherwise(0) for k, x in enumerate([*fails, good, toxic])]
    code = bits[0]
    for bit in bits[1:]:
        code = code + bit
    sums = rows.select(F.coalesce(part.cast("string"), F.lit("")).alias("part"), code.alias("code")).mapInArrow(
        _adder(name, HELD), _SUMS)
    spread = sums.withColumn("salt", F.spark_partition_id() % SALTS).repartition("part", "salt").drop("salt")
    fewer = spread.mapInArrow(_merger(name, HELD), _SUMS).repartition("part").sortWithinPartitions("part")
    counts = ", ".join(f"{k} long" for k in (*KINDS, "shapley"))
    return fewer.mapInArrow(_opener(name), f"part string, filter_order string, step int, filter string, {counts}")


def text_checks(text: Column) -> dict[str, Column]:
    """The failure conditions that a text alone decides; null counts as empty.

    A: under 100 words; B: fewer than 80 of 100 words are different; C: more
    than a tenth of the code points are ``A`` to ``Z``; D: one of ``#$%&*|``.
    """
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(0))
    count, different = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]", "")).cast("long")
    return {
        "A": count < 100,
        "B": 100 * different < 80 * count,
        "C": 100 * capitals > 10 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def documents_audit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """``audit`` of the filters A to E over ``docs``, by ``part``.

    A to D are those of ``text_checks``; a row fails E if a smaller identifier
    has an identical text, in whatever part and whether removed or not.  Equal
    texts are found by their SHA-256 digests.  Each text is read once: a narrow
    table of masks and digests is written, and the smallest identifier of each
    digest meets its own row again by digest *and* identifier, so a text that a
    third of the rows share is no hot key.  A null identifier is neither smaller
    nor larger than another: its row never fails E, nor makes another fail.

    ``labels`` (``id``, ``quality``, ``toxic``) mark a document good or toxic
    if one of its rows says 1; rows without an identifier have no label.
    """
    checks = text_checks(F.col(text))
    content = F.coalesce(F.col(text), F.lit(""))
    narrow = materialize(spark, docs.select(
        F.col(id).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(content, 256)).alias("digest"), *[c.alias(f"fails_{k}") for k, c in checks.items()],
    ), "filter-audit")
    first = narrow.where(F.col("id").isNotNull()).groupBy("digest").agg(F.min("id").alias("id")).withColumn(
        "first", F.lit(True))
    marks = labels.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = narrow.join(first, ["digest", "id"], "left").join(marks, "id", "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    return audit(
        spark, rows, [*checks, "E"], F.col("part"), [*[F.col(f"fails_{k}") for k in checks], copy],
        F.col("good"), F.col("toxic"),
    )
