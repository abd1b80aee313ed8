"""File sinks: CSV export, size-bounded split, bulk load into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from starload.operators.keys import number_rows
from starload.session import stored
from starload.sources.files import read_delimited


def _csv_writer(df: DataFrame, mode: str, sep: str):
    """Values come back as they were: blanks at both ends stay, an empty text
    is written as ``""`` and NULL as nothing, quotes are doubled."""
    return (
        df.write.mode(mode)
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def _one_line(df: DataFrame) -> DataFrame:
    """Raises on a line end inside a text value, which would break the row in
    two for every reader that splits files into tasks."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    checked = {
        c: F.when(F.col(f"`{c}`").contains("\r") | F.col(f"`{c}`").contains("\n"), F.raise_error(F.lit(f"line end in column {c}")))
        .otherwise(F.col(f"`{c}`"))
        for c in texts
    }
    return df.select(*[checked[c].alias(c) if c in checked else F.col(f"`{c}`") for c in df.columns])


def export_csv(
    df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite", multi_line: bool = False,
    compression: str | None = None,
) -> None:
    """CSV with a header (K3), as plain text or in files of a ``compression`` that Spark
    knows, whose readers find it by the file name.

    A line end inside a value raises, unless ``multi_line``; such files have to
    be read with ``multi_line`` as well and are not split into tasks.  gzip is used at
    its fastest level.
    """
    writer = _csv_writer(df if multi_line else _one_line(df), mode, sep)
    if compression == "gzip":
        writer = writer.option("zlib.compress.level", "BEST_SPEED")
    writer.csv(path, compression=compression)


def export_one(df: DataFrame, path: str, sep: str = ",") -> None:
    """One CSV file with a header (K3).

    One task writes it.  All tasks make the rows, as a table in columns, so that
    the one reads a few bytes a row and no exchange of whole rows.
    """
    rows = stored(_one_line(df), "one-file")
    _csv_writer(rows.coalesce(1), "overwrite", sep).csv(path)


def export_split(df: DataFrame, path: str, max_rows: int, sep: str = ",") -> None:
    """CSV files of at most ``max_rows`` rows each (K4).

    The bound holds per output file; tasks write in parallel, so files hold
    up to ``max_rows`` rows, not exactly that many.
    """
    _csv_writer(_one_line(df), "overwrite", sep).option("maxRecordsPerFile", max_rows).csv(path)


def export_exact(
    df: DataFrame,
    path: str,
    rows: int,
    order_cols: Sequence[str] = (),
    sep: str = ",",
    multi_line: bool = False,
) -> int:
    """CSV files of exactly ``rows`` rows each, the last one of what is left (K4);
    returns the number of files.

    File k holds the rows from k * ``rows`` on, in the order of ``order_cols`` or,
    without them, in the order that ``df`` has.  The rows are numbered by a count
    of each partition, then each goes to the task of its file by that number: one
    exchange, whose tasks are as large as a file, and no task sees more.  File
    names sort in the order of the files' numbers.  A frame without rows makes one
    file with the header alone.
    """
    if rows < 1:
        raise ValueError("a file has at least one row")
    place = "__row"
    while place in df.columns:
        place += "_"
    numbered, total = number_rows(df if multi_line else _one_line(df), order_cols, start=-1, id_col=place)
    files = max(1, -(-total // rows))
    dealt = numbered.repartitionById(files, F.expr(f"cast({place} div {rows} as int)"))
    _csv_writer(dealt.sortWithinPartitions(place).drop(place), "overwrite", sep).csv(path)
    return files


def bulk_load(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: StructType,
    target_path: str,
    sep: str = ",",
    header: bool = True,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Load one CSV file, a folder or a glob into a Parquet table by append (K5).

    A folder is one parallel job over all files, not a loop per file.
    Returns the loaded table as read back from the target.
    """
    rows = read_delimited(spark, paths, schema, sep=sep, header=header, mode="FAILFAST")
    writer = rows.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(target_path)
    return spark.read.parquet(target_path)
