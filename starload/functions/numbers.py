"""Number parsing and integer casts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starload.functions.text import NBSP


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_number_text(c: str | Column) -> Column:
    """Drop no-break spaces and turn the decimal comma into a dot."""
    return F.replace(F.replace(_col(c), F.lit(NBSP), F.lit("")), F.lit(","), F.lit("."))


#: Decimal numbers as they may be typed; a Java double also takes ``5d`` or ``NaN``.
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_number(c: str | Column, strict: bool = False) -> Column:
    """Localised number text -> BIGINT.

    Integer text is taken as is; otherwise the value is read as a decimal
    number and truncated toward zero (``1 234,56`` -> 1234, ``-3,9`` -> -3).
    Unparsable text gives NULL, or raises when ``strict``.
    """
    text = normalise_number_text(c)
    decimal = F.when(text.rlike(_DECIMAL), text.try_cast("double"))
    parsed = F.coalesce(text.try_cast("bigint"), decimal.try_cast("bigint"))
    if not strict:
        return parsed
    return F.when(
        parsed.isNull() & text.isNotNull(),
        F.raise_error(F.concat(F.lit("cannot parse number: "), text)),
    ).otherwise(parsed)


def cast_int(c: str | Column) -> Column:
    """Cast to 32-bit integer (C7); under ANSI mode an overflow raises."""
    return _col(c).cast("int")


def try_int(c: str | Column) -> Column:
    """Integer if the text parses, else NULL (C8); keep the text alongside."""
    return _col(c).try_cast("int")


def mixed_cell(c: str | Column) -> Column:
    """A cell as it was meant (C8): an integer if the text parses, else the text,
    in one VARIANT column; NULL stays NULL.

    ``schema_of_variant`` tells which it is, ``try_variant_get`` takes it out, and
    Parquet keeps it.
    """
    text = _col(c)
    number = text.try_cast("int")
    return F.when(number.isNotNull(), number.cast("variant")).otherwise(text.cast("variant"))


def fits_decimal(c: str | Column, precision: int = 10, scale: int = 2) -> Column:
    """True when a non-NULL value fits ``DECIMAL(precision, scale)`` (Q5)."""
    col = _col(c)
    return col.isNull() | col.try_cast(f"decimal({precision},{scale})").isNotNull()
