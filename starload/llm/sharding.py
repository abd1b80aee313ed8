"""Sharding by a keyed permutation of global row numbers.

Rows get their number in the order of a key.  A Feistel network over the pairs
``(row // b, row % b)``, with ``a * b`` just above the row count and modular
addition in both halves, permutes these numbers; a value beyond the count is
sent through the network again until it falls inside (cycle walking).  The
permuted number ``p`` gives ``shard = p % shards`` and ``slot = p // shards``,
so anyone who knows the row count, the seed and the row number can compute the
place of a row, and shard sizes differ by one row at most.

Only native expressions are used.  The numbering takes one range exchange and
no global task: the rows are frozen with their place in their partition, and
the partitions' row counts (one row each) are summed up.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starload.llm.common import free_name, materialize

#: Round constants of the network: multiplier, increment and prime modulus.
ROUNDS = ((1103515245, 12345), (69069, 362437), (1664525, 1013904223), (22695477, 7919))
PRIME = 2147483647
#: Times the network is applied again to a value beyond the row count.  At most
#: ``a`` values lie beyond it, so 64 covers every path while there are up to
#: 4,096 rows; with more rows a path of 64 such values has a chance below
#: 2**-380, and it raises an error instead of giving a wrong place.
WALK = 64


def halves(rows: int) -> tuple[int, int]:
    """The least ``a`` with ``a * a >= rows``, and the least ``b`` with ``a * b >= rows``."""
    a = max(1, math.isqrt(max(rows, 1) - 1) + 1)
    return a, max(1, -(-rows // a))


def round_value(half, seed: int, k: int):
    """Round function: a hash of one half; works on columns and on integers."""
    mul, add = ROUNDS[k]
    x = (half % PRIME * mul + (add + seed % PRIME)) % PRIME
    return (x * 48271 + x % 65537) % PRIME


def network(x: Column, a: int, b: int, seed: int) -> Column:
    """One pass of the Feistel network over ``0 .. a * b - 1``."""

    def step(k: int):
        def even(s: Column) -> Column:
            return F.struct(((s["l"] + round_value(s["r"], seed, k)) % a).alias("l"), s["r"].alias("r"))

        def odd(s: Column) -> Column:
            return F.struct(s["l"].alias("l"), ((s["r"] + round_value(s["l"], seed, k)) % b).alias("r"))

        return odd if k % 2 else even

    state = F.array(F.struct(F.floor(x / F.lit(b)).cast("long").alias("l"), (x % b).alias("r")))
    for k in range(len(ROUNDS)):
        # transform() names the state once, so that the expression stays small
        state = F.transform(state, step(k))
    return state[0]["l"] * b + state[0]["r"]


def permute(row: Column, rows: int, seed: int) -> Column:
    """Place of row number ``row`` (0 .. rows - 1) in the shuffle of all rows."""
    a, b = halves(rows)

    def again(x: Column) -> Column:
        return F.when(x < rows, x).otherwise(network(x, a, b, seed))

    walked = F.transform(
        F.array(network(row, a, b, seed)),
        lambda x: F.when(x < rows, x).otherwise(
            F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), x, lambda acc, _: again(acc))
        ),
    )[0]
    return F.transform(
        F.array(walked),
        lambda x: F.when(x < rows, x).otherwise(
            F.raise_error(F.lit("cycle walking did not end")).cast("long")
        ),
    )[0]


def number_rows(spark: SparkSession, df: DataFrame, keys: list[Column], name: str) -> tuple[DataFrame, int]:
    """``df`` with ``name``: 0 .. n - 1 in the order of ``keys``; and n.

    Rows that agree in all keys may stand in either order.  The last range key
    is the position in the scan, so a group of equal keys is split over tasks.
    """
    at, part, start = free_name(df, "_at"), free_name(df, "_part"), free_name(df, "_start")
    key_cols = [free_name(df, f"_key{i}") for i in range(len(keys))]
    keyed = df.withColumns(
        dict(zip(key_cols, keys, strict=True)) | {at: F.monotonically_increasing_id()}
    )
    frozen = materialize(
        spark,
        keyed.repartitionByRange(*key_cols, at)
        .sortWithinPartitions(*key_cols, at)
        .select(*df.columns, F.monotonically_increasing_id().alias(at)),
        "numbered",
    )
    frozen = frozen.withColumn(part, F.shiftright(at, 33))
    counts = frozen.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(start), "_n")
    starts = materialize(spark, starts, "starts")
    total = starts.agg(F.sum("_n")).first()[0] or 0
    # one row for each partition of the range exchange: that many tasks ran
    numbered = frozen.join(F.broadcast(starts.drop("_n")), part, "left").select(
        *df.columns, (F.col(start) + F.col(at).bitwiseAND((1 << 33) - 1)).alias(name)
    )
    return numbered, total


def shard(
    spark: SparkSession,
    df: DataFrame,
    keys: list[Column],
    shards: int,
    seed: int = 20240,
    shard_col: str = "shard",
    slot_col: str = "slot",
) -> DataFrame:
    """``df`` with its shard and its slot in that shard (gapless from 0).

    The shuffle depends on the order of ``keys``, the row count, ``shards`` and
    ``seed`` alone.  Nulls sort first, texts may be empty or null, rows that
    agree in all keys are told apart by their position, an empty table stays
    empty, and every column of ``df`` is kept; if one has the name of a new
    column, the new one gets underscores.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    shard_col, slot_col = free_name(df, shard_col), free_name(df, slot_col)
    row = free_name(df, "_row")
    numbered, total = number_rows(spark, df, keys, row)
    placed = free_name(df, "_place")
    return numbered.withColumn(placed, permute(F.col(row), max(1, total), seed)).select(
        *df.columns,
        (F.col(placed) % shards).cast("int").alias(shard_col),
        F.floor(F.col(placed) / shards).cast("long").alias(slot_col),
    )
