"""Text cleansing as JVM column expressions (no Python UDF)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Fixed value: the characters Python's ``str.split()`` treats as whitespace are
# Unicode White_Space (Java ``(?U)\s``) plus the ASCII separators U+001C..U+001F.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"

# Fixed value: the no-break space used as a thousands separator in exports.
NBSP = "\u00a0"


def clean_text(c: str | Column) -> Column:
    """Collapse every whitespace run to one space and strip both ends.

    Equals ``' '.join(s.split())`` in Python, NBSP included; NULL stays NULL.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.trim(F.regexp_replace(col, WHITESPACE_RUN, " "))


def clean_all_text(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """Apply ``clean_text`` to every string column except ``exclude``.

    NULL-safe per value, so one NULL does not stop the other columns.
    """
    skip = set(exclude)
    return df.select(
        *[
            clean_text(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, StringType) and f.name not in skip
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
