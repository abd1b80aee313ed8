"""Projections and row filters written so Catalyst pushes them to the scan.

Text filters are ORs of ``contains`` (pushed to Parquet as ``StringContains``;
a regular expression would not be pushed).  Day ranges compare the date of a
timestamp, which Spark rewrites into a pushed timestamp range.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep and order the named columns (F1)."""
    return df.select(*cols)


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position (F2); the count must match."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def contains_any(c: str | Column, phrases: Sequence[str]) -> Column:
    """True when the text contains at least one phrase (F3); NULL text -> NULL."""
    col = _col(c)
    return reduce(lambda a, b: a | b, [col.contains(p) for p in phrases])


def contains_all(c: str | Column, phrases: Sequence[str]) -> Column:
    """True when the text contains every phrase (F4, stacked filters)."""
    col = _col(c)
    return reduce(lambda a, b: a & b, [col.contains(p) for p in phrases])


def filter_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Parameterised equality filter (F5); the value is bound, never spliced."""
    return df.where(F.col(column) == F.lit(value))


def is_true(c: str | Column) -> Column:
    """``x IS TRUE``: NULL counts as not true."""
    return _col(c).eqNullSafe(F.lit(True))


def _as_date(value) -> Column:
    if isinstance(value, Column):
        return F.to_date(value)
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat()[:10]
    return F.to_date(F.lit(str(value)))


def between_days(c: str | Column, start, end) -> Column:
    """``date(c) >= start AND date(c) <= end`` — both ends inclusive."""
    day = F.to_date(_col(c))
    return (day >= _as_date(start)) & (day <= _as_date(end))
