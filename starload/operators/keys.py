"""Dense surrogate keys without a single-partition window.

``row_number() OVER (ORDER BY k)`` moves every row into one task.  Instead, at
every size:

1. the rows are range-partitioned on the full row order, sorted inside each
   partition and numbered there (``monotonically_increasing_id`` carries the
   partition index in its upper bits and the position in its lower 33 bits);
2. the numbered rows are written to a table in the shared checkpoint folder,
   because range bounds are sampled anew in each execution and a lost executor
   must not change the numbers;
3. each partition adds the row count of all earlier partitions, taken from a
   table with one row per partition, which is made once and reads nothing but
   the numbers.

Rows are ordered by the requested columns and then by every other column, so
only exact duplicates can swap places, and swapping identical rows leaves the
result unchanged.  Ranging on the full order also splits a key value held by
many rows over several partitions.

Rows whose ids need no order (facts) are numbered in the partitions they are
already in: steps 2 and 3 alone, without an exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starload.session import checkpoint_dir, scratch_path

_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def max_id(df: DataFrame, id_col: str = "id") -> int:
    """Current largest id (0 for an empty table); one scalar to the driver."""
    row = df.agg(F.max(id_col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def _placed(df: DataFrame) -> DataFrame:
    """``df``, frozen, with each row's place in its partition (``__mid``)."""
    path = scratch_path(df.sparkSession, "placed")
    typed = [c for c, kind in df.dtypes if kind != "void"]  # a file has no column without a type
    df.select(*[F.col(f"`{c}`") for c in typed], F.monotonically_increasing_id().alias("__mid")).write.option(
        "compression", "zstd").parquet(path)
    written = df.sparkSession.read.parquet(path)
    return written.select(
        *[F.col(f"`{c}`") if c in typed else F.lit(None).alias(c) for c in df.columns], "__mid")


def _starts(placed: DataFrame) -> DataFrame:
    """Rows before each partition, and its own: one row per partition, so the
    table is bounded and may be ordered in one task and broadcast.  It is
    stored, as it is used twice."""
    counts = placed.groupBy(F.shiftright("__mid", _POSITION_BITS).alias("__pid")).agg(
        F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    checkpoint_dir(placed.sparkSession)
    return counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).checkpoint()


def _numbered(placed: DataFrame, starts: DataFrame, start: int, id_col: str) -> DataFrame:
    columns = [c for c in placed.columns if c != "__mid"]
    keyed = placed.withColumn("__pid", F.shiftright("__mid", _POSITION_BITS)).join(
        F.broadcast(starts), "__pid")
    position = F.col("__mid").bitwiseAND(F.lit(_POSITION_MASK))
    new_id = (F.lit(start) + F.col("__before") + position + 1).cast("bigint")
    return keyed.select(new_id.alias(id_col), *[F.col(f"`{c}`") for c in columns])


def number_rows(
    df: DataFrame,
    order_cols: Sequence[str | Column] = (),
    start: int = 0,
    id_col: str = "id",
    num_partitions: int | None = None,
) -> tuple[DataFrame, int]:
    """``df`` with ``id_col`` = start+1, start+2, ... and the number of rows.

    With ``order_cols`` the numbers follow the full row order that begins with
    them; without, they follow the partitions and the places the rows are in,
    and nothing is moved or sorted.  ``num_partitions`` sets the number of
    ranges; else there are as many as shuffle partitions.
    """
    if order_cols:
        named = {c for c in order_cols if isinstance(c, str)}
        order = [*order_cols, *[F.col(f"`{c}`") for c in df.columns if c not in named]]
        ranged = df.repartitionByRange(*([num_partitions] if num_partitions else []), *order)
        df = ranged.sortWithinPartitions(*order)
    placed = _placed(df)
    starts = _starts(placed)
    total = starts.agg(F.sum("__n")).first()[0] or 0
    return _numbered(placed, starts, start, id_col), total


def assign_keys(
    df: DataFrame,
    order_cols: Sequence[str | Column],
    start: int = 0,
    id_col: str = "id",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``id_col`` = start+1, start+2, ... following ``order_cols``."""
    return number_rows(df, order_cols, start, id_col, num_partitions)[0]


def assign_keys_unordered(
    df: DataFrame, start: int = 0, id_col: str = "id"
) -> tuple[DataFrame, int]:
    """Dense ids in no particular order, and the largest one given.

    No exchange and no sort: the rows are numbered where they are.  The last id
    comes from the partition counts, not from a scan of the ids.
    """
    keyed, total = number_rows(df, (), start, id_col)
    return keyed, start + total


def number_in_files(df: DataFrame, file: str, block: str, row: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``row``, each row's place in its file from 0, and a table of the
    files: ``file``, its ``rows``, and the rows ``before`` it in the files' order.

    ``file`` and ``block`` are columns of ``df`` with the file a row was read from
    and the start of the block of it; nothing but filters and projections may lie
    between the scan and ``df``.  Rows of a block are consecutive in one task, so
    the place in a block is known there, and a table with one row a block adds
    what lies before.  The places do not depend on how Spark cuts the files.
    """
    placed = _placed(df)
    counts = placed.groupBy(file, block).agg(F.min("__mid").alias("__first"), F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    checkpoint_dir(df.sparkSession)
    starts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).checkpoint()
    numbered = placed.join(F.broadcast(starts.drop("__n")), [file, block]).withColumn(
        row, F.col("__before") + F.col("__mid") - F.col("__first")).drop("__before", "__mid", "__first")
    order = Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    files = starts.groupBy(file).agg(F.sum("__n").alias("rows")).withColumn(
        "before", F.coalesce(F.sum("rows").over(order), F.lit(0)))
    return numbered, files
