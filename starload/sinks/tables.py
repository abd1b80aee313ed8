"""Table sinks: append, versioned snapshot replace, CTAS, truncate, typed DDL.

A file table cannot be overwritten by a plan that reads it, and it takes no
``MERGE``.  ``SnapshotTable`` therefore writes every new state to a fresh
folder and names it in a small entry afterwards; entries are only ever added,
so readers of an old version are not disturbed and a failed write leaves
nothing that a reader would see.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starload.sinks.notes import list_notes, read_note, remove_note, write_note


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows to a Parquet table (K1)."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


class ConcurrentWriteError(RuntimeError):
    """Another writer published the same number first."""


class Entries:
    """Numbered JSON entries under ``root``, one file each, never overwritten.

    The highest complete one is current.  There is one name for each number and
    it is created only if nothing has it, so of two writers that start after the
    same entry one succeeds and the other gets an error, in whatever order they
    come.  A writer that is lost while it writes leaves an incomplete entry:
    readers pass over it, and later writers get the error until it is removed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def last(self, n: int) -> list[dict]:
        """The last ``n`` complete entries, the current one first."""
        found: list[dict] = []
        for name in reversed(list_notes(self.spark, self.root)):
            if name.startswith("entry-") and len(found) < n:
                try:
                    found.append(json.loads(read_note(self.spark, f"{self.root}/{name}") or ""))
                except ValueError:
                    continue
        return found

    def latest(self) -> dict | None:
        """The current entry, None if there is none."""
        return next(iter(self.last(1)), None)

    def publish(self, tag: str, after: int, **values) -> None:
        """Adds entry ``after + 1``; it counts once it is written completely."""
        number = after + 1
        text = json.dumps({"number": number, "tag": tag, **values}, ensure_ascii=False)
        try:
            write_note(self.spark, f"{self.root}/entry-{number:09d}.json", text)
        except FileExistsError:
            raise ConcurrentWriteError(f"another writer published number {number} under {self.root}") from None


def new_tag() -> str:
    return uuid.uuid4().hex[:12]


class SnapshotTable:
    """Versioned table under ``root``: a folder for each version, and entries
    that name them.  Folders of old versions stay readable until
    the storage's owner removes them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.entries = Entries(spark, f"{self.root}/_versions")

    def current_version(self) -> int | None:
        row = self.entries.latest()
        return row["number"] if row else None

    def exists(self) -> bool:
        return self.entries.latest() is not None

    def read(self) -> DataFrame:
        row = self.entries.latest()
        if row is None:
            raise FileNotFoundError(f"no snapshot under {self.root}")
        return self.spark.read.parquet(row["path"])

    def replace(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Write ``df`` as the next version, which readers then see (K2)."""
        version = self.current_version() or 0
        tag = new_tag()
        path = f"{self.root}/v{version + 1:06d}-{tag}"
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        self.entries.publish(tag, version, path=path)
        return version + 1


class PeriodFolders:
    """Facts in folders by the day or month of ``dt_col``.

    A write makes a fresh set of folders and returns their paths; which folders
    make up the table is for the caller to keep.  Rows without a date have a
    folder of their own, which overlaps no range.
    """

    NO_DATE = "__HIVE_DEFAULT_PARTITION__"

    def __init__(self, spark: SparkSession, dt_col: str = "dt", period: str = "month"):
        if period not in ("day", "month"):
            raise ValueError("period must be 'day' or 'month'")
        self.spark = spark
        self.dt_col = dt_col
        self.period = period
        self.part_col = f"{period}_start"

    def period_of(self, c) -> "F.Column":
        d = F.to_date(c)
        return d if self.period == "day" else F.trunc(d, "month")

    def write(self, df: DataFrame, root: str, id_col: str = "id",
              finish: Callable[[DataFrame], DataFrame] | None = None) -> list[str]:
        """Write ``df`` under ``root``; the paths of the folders it fills.

        The rows are range-partitioned on date and id: a task covers a short
        stretch of days, so it writes few folders, one busy date is still split
        over several tasks, and files have tight date bounds for pruning.  The
        list has an entry for each calendar period, whatever the row count.
        ``finish`` adds columns that the exchange need not carry.
        """
        ranged = df.repartitionByRange(self.dt_col, id_col)
        rows = finish(ranged) if finish else ranged
        dated = rows.withColumn(self.part_col, self.period_of(F.col(self.dt_col)))
        dated.write.partitionBy(self.part_col).option("compression", "zstd").parquet(root)
        return self.folders(root)

    def folders(self, root: str) -> list[str]:
        """The period folders that a write left under ``root``."""
        return [f"{root}/{name}" for name in list_notes(self.spark, root) if name.startswith(f"{self.part_col}=")]

    def read(self, folders: Sequence[str], schema: StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def overlapping(self, folders: Sequence[str], start, end) -> tuple[list[str], list[str]]:
        """The folders whose period overlaps [start, end], and the others."""
        first, last = str(start)[:10], str(end)[:10]
        if self.period == "month":
            first, last = f"{first[:7]}-01", f"{last[:7]}-01"
        inside, outside = [], []
        for folder in folders:
            value = folder.rsplit("=", 1)[1]
            (inside if value != self.NO_DATE and first <= value <= last else outside).append(folder)
        return inside, outside


def _bucketed_name(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()[:20]}"


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, spread: bool = True) -> DataFrame:
    """Write ``df`` under ``path`` in ``buckets`` by a hash of ``keys``, in no order, and
    read it back (M1-M3).

    A join on the keys then needs no exchange on this side.  ``spread`` sends each
    bucket to one task first; what comes out of a join with such a table is
    there already and is written as it is.
    """
    spark = df.sparkSession
    rows = df.repartition(buckets, *keys) if spread else df
    spark.sql(f"DROP TABLE IF EXISTS {_bucketed_name(path)}")
    rows.write.bucketBy(buckets, *keys).option("path", path).format("parquet").saveAsTable(
        _bucketed_name(path))
    return spark.table(_bucketed_name(path))


def read_bucketed(spark: SparkSession, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """What ``write_bucketed`` wrote; a session whose catalog does not know the
    folder is told of its buckets."""
    name = _bucketed_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}' "
                  f"CLUSTERED BY ({by}) INTO {buckets} BUCKETS")
    return spark.table(name)


def remove_folders(spark: SparkSession, folders: Sequence[str]) -> None:
    """Delete folders, and the tables that ``write_bucketed`` made of them."""
    for folder in folders:
        spark.sql(f"DROP TABLE IF EXISTS {_bucketed_name(folder)}")
        remove_note(spark, folder)


def create_table_as(
    spark: SparkSession,
    name: str,
    df: DataFrame,
    partition_by: Sequence[str] = (),
    path: str | None = None,
) -> DataFrame:
    """``DROP TABLE IF EXISTS`` then create the table from ``df`` (K6).

    With ``path`` the table is external (its files live there); otherwise it
    is a managed table in ``spark.sql.warehouse.dir``.
    """
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def truncate_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Empty landing tables between loads (K7).

    ``TRUNCATE TABLE`` where Spark allows it (managed tables); an external
    table is overwritten with no rows instead, which empties it the same way.
    """
    for name in names:
        try:
            spark.sql(f"TRUNCATE TABLE {name}")
        except AnalysisException:
            empty = spark.createDataFrame([], spark.table(name).schema)
            empty.write.insertInto(name, overwrite=True)


def create_tables(spark: SparkSession, ddl: dict[str, str], locations: dict[str, str] | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS name (columns) USING parquet`` per entry (K8).

    Column text may use ``VARCHAR(n)`` (length enforced on write), ``DECIMAL``
    and ``DEFAULT`` clauses (filled in when an insert omits the column).
    ``locations`` makes the named tables external.  Primary, unique and
    foreign keys are checked by ``operators.quality``.
    """
    locations = locations or {}
    for name, columns in ddl.items():
        where = f" LOCATION '{locations[name]}'" if name in locations else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")
