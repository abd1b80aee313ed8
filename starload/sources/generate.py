"""Generated inputs: date series, synthetic sales rows, template expansion.

All three are distributed: rows come from ``spark.range`` or from an existing
DataFrame, never from a driver-side list or one exploded array.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The synthetic sales vocabulary and value range (inclusive).
SALES_MANAGERS = ["m1", "m2", "m3"]
SALES_PRODUCTS = ["pr1", "pr2", "pr3", "pr4", "pr5"]
SALES_VALUE_MIN = 100
SALES_VALUE_MAX = 1000

# The classic ANSI C ``rand()`` linear congruential step.
LCG_MULTIPLIER = 1103515245
LCG_INCREMENT = 12345
LCG_MODULUS = 2147483648
LCG_SHIFT = 65536


def _to_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def date_series(
    spark: SparkSession,
    start,
    end,
    step_days: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Every ``step_days``-th date from ``start`` to ``end``, both inclusive.

    Built on ``spark.range`` so the rows are spread over tasks; the dates are
    ``DATE`` values, so the session time zone cannot shift a day.
    """
    first, last = _to_date(start), _to_date(end)
    if step_days <= 0:
        raise ValueError("step_days must be positive")
    n = max((last - first).days // step_days + 1, 0)
    ids = spark.range(0, n, 1, num_partitions) if num_partitions else spark.range(n)
    return ids.select(
        F.date_add(F.lit(first), (F.col("id") * step_days).cast("int")).alias("date")
    )


def lcg_pick(key: Column, salt: int, modulus: int) -> Column:
    """Deterministic pseudo-random integer in ``[0, modulus)`` from a key.

    One LCG step over ``key mod 2^31`` (so the product stays inside BIGINT),
    then the high bits, as ``rand()`` returns them.  The same integer
    arithmetic runs in any SQL engine, which keeps the output checkable.
    """
    x = F.pmod(key.cast("bigint"), F.lit(LCG_MODULUS))
    x = F.pmod(x * LCG_MULTIPLIER + (LCG_INCREMENT + salt), F.lit(LCG_MODULUS))
    return F.pmod(F.floor(x / LCG_SHIFT), F.lit(modulus))


def sales_columns(key: Column, seed: int = 0) -> list[Column]:
    """Manager, product and value picked uniformly from ``key``."""
    k = key + F.lit(seed * 1_000_003)
    span = SALES_VALUE_MAX - SALES_VALUE_MIN + 1
    managers = F.array(*[F.lit(m) for m in SALES_MANAGERS])
    products = F.array(*[F.lit(p) for p in SALES_PRODUCTS])
    return [
        F.element_at(managers, (lcg_pick(k, 0, len(SALES_MANAGERS)) + 1).cast("int")).alias(
            "manager"
        ),
        F.element_at(products, (lcg_pick(k, 1, len(SALES_PRODUCTS)) + 1).cast("int")).alias(
            "product"
        ),
        (lcg_pick(k, 2, span) + SALES_VALUE_MIN).cast("float").alias("val"),
    ]


def generate_sales(spark: SparkSession, n: int, dt, seed: int = 0) -> DataFrame:
    """``n`` synthetic sales rows ``(dt, manager, product, val)``.

    ``dt`` is one load date for every row, fixed by the caller.
    """
    ids = spark.range(n)
    return ids.select(F.lit(_to_date(dt)).alias("dt"), *sales_columns(F.col("id"), seed))


def sales_from_keys(df: DataFrame, key: str | Column, dt: str | Column, seed: int = 0) -> DataFrame:
    """One synthetic sales row per input row, picked from the row's key."""
    k = F.col(key) if isinstance(key, str) else key
    d = F.col(dt) if isinstance(dt, str) else dt
    return df.select(F.to_date(d).alias("dt"), *sales_columns(k, seed))


def expand_template(df: DataFrame, column: str, token: str, copies: int) -> DataFrame:
    """``copies`` copies of every row; in copy ``step`` (1..copies) the first
    ``token`` in ``column`` becomes ``token + step`` (S9).

    The copies come from a per-row generator (``explode(sequence)``), which
    is narrow: no join, no shuffle.
    """
    pattern = r"(?s)^(.*?)\Q" + token + r"\E"
    replacement_prefix = "$1" + token.replace("\\", "\\\\").replace("$", "\\$")
    steps = df.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    return steps.withColumn(
        column,
        F.regexp_replace(
            F.col(column),
            F.lit(pattern),
            F.concat(F.lit(replacement_prefix), F.col("step").cast("string")),
        ),
    )
