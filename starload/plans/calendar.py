"""Calendar (date) dimension: a date series with 22 attributes per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.dates import calendar_columns
from starload.sources.generate import date_series

# The reference calendar range.
CALENDAR_START = "1770-01-01"
CALENDAR_END = "2030-12-31"


def date_dimension(
    spark: SparkSession,
    start=CALENDAR_START,
    end=CALENDAR_END,
    num_partitions: int | None = None,
) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, 22 columns."""
    days = date_series(spark, start, end, num_partitions=num_partitions)
    return days.select(*calendar_columns(F.col("date")))


def date_dimension_for(df: DataFrame, *date_columns: str) -> DataFrame:
    """Calendar spanning the dates present in ``df``'s ``date_columns``.

    Only the two bounds reach the driver; the days themselves are generated
    in parallel.
    """
    lows = [F.min(F.to_date(c)) for c in date_columns]
    highs = [F.max(F.to_date(c)) for c in date_columns]
    bounds = df.agg(
        (F.least(*lows) if len(lows) > 1 else lows[0]).alias("lo"),
        (F.greatest(*highs) if len(highs) > 1 else highs[0]).alias("hi"),
    ).first()
    if bounds is None or bounds["lo"] is None:
        return date_dimension(df.sparkSession, "2000-01-01", "1999-12-31")
    return date_dimension(df.sparkSession, bounds["lo"], bounds["hi"])
