"""Aggregations: grouped sums over resolved names, row counts, column profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sum_by(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]
) -> DataFrame:
    """``GROUP BY keys`` with ``sum(src) AS out`` per ``measures`` item.

    NULL keys form their own group, as in SQL.  Spark plans a partial
    (map-side) aggregate before the shuffle, so only one row per key and
    task crosses the network even when one key holds most of the rows.
    """
    return df.groupBy(*keys).agg(
        *[F.sum(src).alias(out) for src, out in measures.items()]
    )


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """``SELECT count(*)`` as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def profile(df: DataFrame) -> DataFrame:
    """Per column: position, name, Spark type and non-NULL count (``df.info()``).

    One aggregation pass computes every count; the single result row is then
    unpivoted, so the job is one scan regardless of the number of columns.
    """
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"__c{i}") for i, f in enumerate(fields)],
    )
    entries = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"__c{i}").alias("non_null"),
            F.col("__rows").alias("row_count"),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(F.explode(F.array(*entries)).alias("p")).select("p.*")
