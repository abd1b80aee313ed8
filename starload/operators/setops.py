"""Appending same-shaped sets and top-n reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """``UNION ALL`` by column name (X1); a narrow operation, no shuffle."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames
    )


def top_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in ``order`` (L1).

    Planned as ``TakeOrderedAndProject``: every task keeps its own top ``n``
    and only those reach the final merge, so the input is never sorted whole.
    """
    return df.orderBy(*order).limit(n)
