"""Equi-join lookups (natural key -> surrogate id, id -> name) and FK checks.

Broadcast policy.  No hint is given: the planner broadcasts a side only when
its size estimate (an upper bound from file sizes) is below
``spark.sql.autoBroadcastJoinThreshold``, and AQE converts a shuffle join to a
broadcast only after the shuffled side has been *measured* below
``spark.sql.adaptive.autoBroadcastJoinThreshold``.  Beyond those bounds both
sides are shuffled on the key and AQE splits skewed fact partitions
(``spark.sql.adaptive.skewJoin.enabled``).  ``hash_side`` marks a side of which a
task's part is known to be small: it is held in memory there, and no side is sorted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(on: Sequence[str] | Mapping[str, str] | str) -> list[tuple[str, str]]:
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(c, c) if isinstance(c, str) else tuple(c) for c in on]


def _conjunction(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


#: Rows of the marked side of a join that a task may hold in memory.
HASH_ROWS = 2_500_000


def may_broadcast(*tables: DataFrame) -> bool:
    """Whether the planner's size estimates let it broadcast all of the tables."""
    spark = tables[0].sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    sizes = [int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables]
    return max(sizes) <= limit


def hash_side(side: DataFrame, rows: int | None = None, tasks: int | None = None) -> DataFrame:
    """``side``, of ``rows`` rows (counted if not given), as the right side of a join
    whose tasks hold their part of it in memory, where else both sides would be sorted:
    for texts that begin alike, as names do, that costs more than the rest of the join.

    Left as it is, for the planner to choose, if it may be broadcast or if there are
    more than ``HASH_ROWS`` rows for each of ``tasks`` (else of the shuffle partitions).
    """
    if may_broadcast(side):
        return side
    tasks = tasks or int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = side.count() if rows is None else rows
    return side if rows > HASH_ROWS * tasks else side.hint("shuffle_hash")


def left_lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[str] | Mapping[str, str] | str,
    take: Mapping[str, str] | Sequence[str] | str,
    how: str = "left",
) -> DataFrame:
    """``fact LEFT JOIN dim ON fact.k = dim.k ...`` adding ``take`` columns.

    ``on`` maps fact columns to dimension columns (a single name or a list
    when both sides share names).  ``take`` maps dimension columns to output
    names.  Unmatched fact rows are kept with NULLs; duplicate dimension keys
    fan out, exactly as a SQL left join does.  A composite key is a list of
    pairs; NULL keys never match.
    """
    pairs = _pairs(on)
    if isinstance(take, str):
        take = {take: take}
    elif not isinstance(take, Mapping):
        take = {c: c for c in take}
    tag = "__lookup_"
    while any(c.startswith(tag) for c in fact.columns):
        tag += "_"
    side = dim.select(
        *[F.col(d).alias(f"{tag}k{i}") for i, (_, d) in enumerate(pairs)],
        *[F.col(src).alias(f"{tag}v_{out}") for src, out in take.items()],
    )
    cond = _conjunction(
        [fact[f] == side[f"{tag}k{i}"] for i, (f, _) in enumerate(pairs)]
    )
    joined = fact.join(side, cond, how)
    out = [c for c in fact.columns if c not in take.values()]
    return joined.select(
        *[fact[c] for c in out],
        *[F.col(f"{tag}v_{o}").alias(o) for o in take.values()],
    )


def scalar_lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str | tuple[str, str],
    value: str,
    out: str | None = None,
    pick: str = "max",
) -> DataFrame:
    """Correlated scalar lookup ``(SELECT value FROM dim WHERE dim.key = df.key)``.

    A SQL scalar function returns one row even when several match; here the
    dimension is first reduced to one value per key (``max`` or ``min``, so
    the result is deterministic) and then left-joined, so a missing key
    gives NULL and nothing fans out.
    """
    left_key, dim_key = (key, key) if isinstance(key, str) else key
    agg = F.max if pick == "max" else F.min
    reduced = dim.groupBy(dim_key).agg(agg(value).alias(value))
    return left_lookup(df, reduced, {left_key: dim_key}, {value: out or value})


def orphans(
    child: DataFrame,
    parent: DataFrame,
    on: Sequence[str] | Mapping[str, str] | str,
) -> DataFrame:
    """Child rows whose non-NULL key has no parent (foreign-key semantics).

    A child row with any NULL key column passes, as a declared foreign key
    lets it pass.  Parent keys are projected (and broadcast when proven
    small, by the planner's size checks) before the anti join.
    """
    pairs = _pairs(on)
    tag = "__fk_"
    keys = parent.select(
        *[F.col(p).alias(f"{tag}{i}") for i, (_, p) in enumerate(pairs)]
    )
    present = _conjunction([child[c].isNotNull() for c, _ in pairs])
    cond = _conjunction([child[c] == keys[f"{tag}{i}"] for i, (c, _) in enumerate(pairs)])
    return child.where(present).join(keys, cond, "left_anti")
