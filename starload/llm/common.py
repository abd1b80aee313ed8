"""Helpers shared by the corpus operators: scratch tables and word hashing."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.session import scratch_path

#: A word is a maximal run of characters other than ASCII white space.
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(spark: SparkSession, df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared scratch folder and read it back;
    ``options`` are the writer's.

    This cuts the lineage (a lost executor costs at most the running stage) and
    freezes the rows.  Shuffle files of the write are dropped when it ends, so
    the disk holds one phase of a job at a time.
    """
    path = scratch_path(spark, f"llm-{name}")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, table: DataFrame) -> None:
    """Delete what ``materialize`` wrote, or the tables of a union of such, once
    nothing reads it any more."""
    jvm = spark.sparkContext._jvm
    for name in {name.rpartition("/")[0] for name in table.inputFiles()}:
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_row(df: DataFrame) -> tuple[DataFrame, str]:
    """The written Parquet table ``df`` with the identity of each row, a struct,
    and that column's name.

    It is the row's file and its place there, so it is the same in every scan,
    however Spark cuts and packs the files into tasks.  Unlike identifiers it is
    never null and never repeats.  What is not a table as read is written first.
    """
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        df = materialize(df.sparkSession, df, "rows")
    name = free_name(df, "_row")
    at = df.metadataColumn("_metadata")
    return df.withColumn(name, F.struct(at["file_path"].alias("file"), at["row_index"].alias("row"))), name


def n_words(text):
    """Number of words of a text column, 0 for null; no array is built."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


class WordIds(dict):
    """64-bit hash of each word (bytes), remembered up to a number of words."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows_of(batch) -> Iterator[tuple]:
    """The rows of an Arrow batch as tuples of Python values."""
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the executors run."""
    sc = spark.sparkContext
    if sc.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp(prefix="starload-package-")
        sc.addPyFile(shutil.make_archive(f"{folder}/starload", "zip", root, "starload"))
        _SHIPPED.add(sc.applicationId)
