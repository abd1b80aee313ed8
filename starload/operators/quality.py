"""Constraint checks (NOT NULL, length, unique, foreign key, decimal fit).

Spark does not enforce declared constraints on file tables, so each check
returns the violating rows (or per-column counts) and can gate a sink.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starload.functions.numbers import fits_decimal
from starload.operators.joins import orphans


class ConstraintViolation(ValueError):
    """Raised by ``require_*`` gates."""


def _stack(df: DataFrame, names: Sequence[str], prefix: str, value: str) -> DataFrame:
    entries = [
        F.struct(F.lit(n).alias("column_name"), F.col(f"{prefix}{i}").alias(value))
        for i, n in enumerate(names)
    ]
    return df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, the number of NULLs (Q1); one scan for all columns."""
    counts = df.agg(
        *[
            F.sum(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)).cast("bigint").alias(f"__n{i}")
            for i, c in enumerate(columns)
        ]
    )
    return _stack(counts, columns, "__n", "null_count").select(
        "column_name", F.coalesce("null_count", F.lit(0)).alias("null_count")
    )


def check_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows where any text is longer than its ``VARCHAR(n)`` limit (Q2)."""
    cond = None
    for col, n in limits.items():
        c = F.length(F.col(f"`{col}`")) > n
        cond = c if cond is None else (cond | c)
    return df.where(cond)


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values occurring more than once, with their count (Q3).

    Partial aggregation runs before the shuffle, so a hot key costs one row
    per task, not one per occurrence.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def check_foreign_key(
    child: DataFrame, parent: DataFrame, on: Sequence[str] | Mapping[str, str] | str
) -> DataFrame:
    """Child rows whose non-NULL key is missing in the parent (Q4)."""
    return orphans(child, parent, on)


def check_decimal(df: DataFrame, columns: Sequence[str], precision: int = 10, scale: int = 2) -> DataFrame:
    """Rows with a value that does not fit ``DECIMAL(precision, scale)`` (Q5)."""
    cond = None
    for col in columns:
        c = ~fits_decimal(F.col(f"`{col}`"), precision, scale)
        cond = c if cond is None else (cond | c)
    return df.where(cond)


def require_empty(violations: DataFrame, what: str) -> None:
    """Raise with a few of the violations if there is any."""
    if violations.limit(1).count() > 0:
        sample = violations.limit(5).collect()
        raise ConstraintViolation(f"{what}: {sample}")


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key repeats (a MERGE source must not match a row twice)."""
    require_empty(check_unique(df, keys), f"duplicate key {list(keys)}")


def require_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    cond = None
    for col in columns:
        c = F.col(f"`{col}`").isNull()
        cond = c if cond is None else (cond | c)
    require_empty(df.where(cond), f"NULL in {list(columns)}")


def require_foreign_key(child: DataFrame, parent: DataFrame, on) -> None:
    require_empty(check_foreign_key(child, parent, on), "foreign key")


def require_length(df: DataFrame, limits: Mapping[str, int]) -> None:
    """Raise for a text longer than its ``VARCHAR(n)`` limit."""
    require_empty(check_length(df, limits), f"longer than {dict(limits)}")
