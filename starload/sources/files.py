"""Delimited-file sources with declared schemas (never inferred).

The exports are UTF-8 with a byte-order mark and CRLF line ends; fields may
hold inner quotes (``ООО "Ромашка"``) and doubled quotes inside quoted fields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starload.sources.records import BOM, read_records

#: Stands for a field with nothing in it while a line is parsed; with Spark's own
#: default, the empty text, ``""`` would read as NULL as well.
NOTHING = "\u0000"

#: Column that takes the text of a malformed line in a lenient read.
REJECTED = "_rejected"


def _csv_options(sep: str, mode: str) -> dict[str, str]:
    return {
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "encoding": "UTF-8",
        "mode": mode,
        # what the exports write: NULL as nothing, an empty text as ""
        "emptyValue": "",
        "nullValue": NOTHING,
        "columnNameOfCorruptRecord": REJECTED,
    }


def _read_csv(spark, path, schema: StructType, sep: str, header: bool, mode: str, multi_line: bool) -> DataFrame:
    options = _csv_options(sep, mode)
    if multi_line:
        return read_records(spark, path, schema, options, header)
    df = spark.read.schema(schema).option("header", header).options(**options).csv(path)
    return df if header else _strip_bom(df)


def _strip_bom(df: DataFrame) -> DataFrame:
    first = df.schema.fields[0]
    if not isinstance(first.dataType, StringType):
        return df
    name = first.name
    return df.withColumn(name, F.regexp_replace(F.col(f"`{name}`"), "^" + BOM, ""))


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    sep: str = "\t",
    header: bool = True,
    mode: str = "FAILFAST",
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text with a declared schema; the header line is discarded and
    columns are named by position (S1).

    A line with too few or too many fields, or with a value that is not of its
    column's type, raises when it is read; ``read_delimited_lenient`` keeps such
    lines apart.  ``multi_line`` allows line ends inside quoted fields; files
    are still split into tasks (``sources.records``), and quotes inside fields
    have to be doubled.
    """
    return _read_csv(spark, path, schema, sep, header, mode, multi_line)


def read_delimited_lenient(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    sep: str = "\t",
    header: bool = True,
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows; and the malformed ones: the columns as far as they could
    be read, and the line as it stands in ``_rejected``."""
    wide = StructType([*schema.fields, StructField(REJECTED, StringType())])
    df = _read_csv(spark, path, wide, sep, header, "PERMISSIVE", multi_line)
    names = [F.col(f"`{f.name}`") for f in schema.fields]
    # always true, but it asks for every column: Spark reads no others than are asked
    # for, and would not see that a line is malformed in the rest
    whole = df.where(F.hash(*names) >= F.lit(-(2**31)))
    return whole.where(F.col(REJECTED).isNull()).select(*names), whole.where(F.col(REJECTED).isNotNull())


def read_glob(
    spark: SparkSession,
    pattern: str | Sequence[str],
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Every file matching a glob as one table (S2); files are split into tasks."""
    return read_delimited(spark, pattern, schema, sep=sep, header=header, mode=mode)


def read_first_column(
    spark: SparkSession,
    path: str | Sequence[str],
    name: str,
    skip_rows: int = 1,
    sep: str = "\t",
) -> DataFrame:
    """First field of every line after ``skip_rows`` lead lines and one header
    line, per file (S3).

    Lines are numbered within their file without an RDD or a per-file task:
    the lines of a file's first block are consecutive in one task, so their
    ``monotonically_increasing_id`` minus the smallest one of the file is the
    line number.  Only the first block can hold the lead lines, and it is at
    most one block a file, so that is all that a window sees of a file.
    """
    lines = spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__mid"),
    )
    head = lines.where(F.col("__block") == 0)
    number = F.col("__mid") - F.min("__mid").over(Window.partitionBy("__file"))
    kept_head = head.withColumn("__line", number).where(F.col("__line") > skip_rows).select("value")
    rest = lines.where(F.col("__block") != 0).select("value")
    value = F.regexp_replace(F.col("value"), "^" + BOM, "")
    return kept_head.unionByName(rest).select(
        F.split(value, _split_pattern(sep), 2).getItem(0).alias(name)
    )


def _split_pattern(sep: str) -> str:
    return r"\Q" + sep + r"\E"
