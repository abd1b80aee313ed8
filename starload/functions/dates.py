"""Date and timestamp parsing plus calendar attributes (JVM expressions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Export formats.  Single-letter fields accept both ``9`` and
# ``09`` (day, month, hour, minute, second), as Python's strptime does.
EXPORT_TIMESTAMP_FORMAT = "d.M.yyyy H:m:s"
EXPORT_DATE_FORMAT = "d.M.yyyy"
ISO_DATE_FORMAT = "yyyy-MM-dd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(
    c: str | Column, fmt: str = EXPORT_TIMESTAMP_FORMAT, strict: bool = True
) -> Column:
    """Text -> TIMESTAMP_NTZ (C4). Strict raises on bad text, else NULL."""
    col = _col(c)
    if strict:
        return F.to_timestamp_ntz(col, F.lit(fmt))
    return F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")


def parse_date(c: str | Column, fmt: str = EXPORT_DATE_FORMAT, strict: bool = False) -> Column:
    """Text -> DATE (C5, C6). Lenient by default: bad text becomes NULL."""
    col = _col(c)
    if strict:
        return F.to_date(col, fmt)
    return F.try_to_date(col, fmt)


def parse_date_report(df: DataFrame, column: str, fmt: str = EXPORT_DATE_FORMAT) -> DataFrame:
    """One-row report: rows, parsed rows, rejected rows, and whether all parsed.

    A typed column cannot fall back to text for the whole column the way a
    pandas column can, so the rejected rows are counted instead.
    """
    parsed = parse_date(column, fmt)
    src = F.col(column)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(parsed).alias("parsed"),
        F.sum(F.when(src.isNotNull() & parsed.isNull(), 1).otherwise(0))
        .cast("bigint")
        .alias("rejected"),
        F.coalesce(F.bool_and(parsed.isNotNull() | src.isNull()), F.lit(True)).alias(
            "all_parsed"
        ),
    )


def date_key(d: Column) -> Column:
    """yyyymmdd as an integer (C14)."""
    return F.date_format(d, "yyyyMMdd").cast("int")


def day_of_week_sunday0(d: Column) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(d) - 1).cast("int")


def week_of_month(d: Column) -> Column:
    """Week of month, days 1-7 -> 1, 8-14 -> 2, ...."""
    return (F.floor((F.dayofmonth(d) - 1) / 7) + 1).cast("int")


def decade_start(d: Column) -> Column:
    """First year of the decade, e.g. 1999 -> 1990 (C11)."""
    return (F.floor(F.year(d) / 10) * 10).cast("int")


def century(d: Column) -> Column:
    """Century with 1900 -> 19 and 1901 -> 20 (C11)."""
    return F.ceil(F.year(d) / 100).cast("int")


def last_day_of_quarter(d: Column) -> Column:
    """Last day of the quarter: start of the next quarter minus one day."""
    return F.date_sub(F.add_months(F.trunc(d, "quarter"), 3), 1)


def calendar_columns(d: Column) -> list[Column]:
    """The 22 calendar attributes of a date, in table order."""
    return [
        d.alias("date"),
        date_key(d).alias("date_key"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        day_of_week_sunday0(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "EEE").alias("day_short_name"),
        F.weekofyear(d).alias("week_number"),
        week_of_month(d).alias("week_of_month"),
        F.trunc(d, "week").alias("week"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short_name"),
        F.trunc(d, "month").alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        F.quarter(d).alias("quarter_number"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter_name"),
        F.trunc(d, "quarter").alias("first_day_of_quarter"),
        last_day_of_quarter(d).alias("last_day_of_quarter"),
        F.year(d).alias("year"),
        decade_start(d).alias("decade"),
        century(d).alias("centurys"),
    ]
