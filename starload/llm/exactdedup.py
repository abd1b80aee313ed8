"""Exact deduplication with streaming keyed state on disk.

A file stream reads the table; its aggregation by content digest keeps, for
every digest ever seen and without expiry, the group's size, the identifier of
the row that stays and the locator (file and row) of that row's content.  The
state lives in RocksDB and its checkpoints in the shared folder, so a later run
over new files goes on from it.  No text enters the state.

A hit (a row whose digest another row has) is checked on full bytes against the
content at the locator.  Where a digest stands for different contents, its rows
are grouped by their full content instead.

Only native expressions are used; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import materialize
from starload.session import scratch_path

_STORE = "spark.sql.streaming.stateStore."
#: State on disk.  Small stores do not reserve space in advance, and a batch
#: uploads its changes instead of whole files.
_SETTINGS = {
    f"{_STORE}providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}rocksdb.allowFAllocate": "false",
    f"{_STORE}rocksdb.changelogCheckpointing.enabled": "true",
}

#: White space that does not count: ASCII blank, tab to carriage return.
DELETED = "\x20\x09\x0a\x0b\x0c\x0d"

#: The file source ignores files that are older than the newest one seen by more
#: than this; a century is before any file's time.
MAX_FILE_AGE = "36500d"

_GROUP = "digest STRING, keep STRUCT<short: INT, no_id: BOOLEAN, id: BIGINT, file: STRING, row: BIGINT>, group_size BIGINT"


def normalise(text: Column) -> Column:
    """The text without white space; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), DELETED, "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class ExactDedup:
    """Deduplicates the Parquet table at ``path`` (columns ``id`` and ``text``).

    The row with the most code points in the original text stays, then the one
    with the smallest identifier (nulls last), then the first in the files.
    Null and empty texts are equal.  Rows may repeat; each keeps its own result
    row.  Other columns of the table are not read.  ``root`` holds the stream's
    checkpoint and its updates; use the same one again after adding files.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        id_col: str = "doc_id",
        text_col: str = "text",
        root: str | None = None,
        digest: Callable[[Column], Column] = sha256,
        files_per_batch: int | None = None,
    ):
        self.spark, self.path, self.digest = spark, path.rstrip("/"), digest
        self.id_col, self.text_col = id_col, text_col
        self.root = root or scratch_path(spark, "llm-exactdedup")
        self.files_per_batch = files_per_batch

    def _rows(self, table: DataFrame, *more: Column) -> DataFrame:
        text = F.col(self.text_col)
        return table.select(
            F.col(self.id_col).cast("long").alias("id"),
            F.coalesce(F.length(text), F.lit(0)).alias("n_chars"),
            self.digest(normalise(text)).alias("digest"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
            *more,
        )

    def _scan(self, *more: Column) -> DataFrame:
        return self._rows(self.spark.read.parquet(self.path), *more)

    @staticmethod
    def _order() -> Column:
        """Least for the row that stays."""
        return F.struct(
            (-F.col("n_chars")).alias("short"), F.col("id").isNull().alias("no_id"), "id", "file", "row"
        )

    def _grouped(self, rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.min(self._order()).alias("keep"), F.count(F.lit(1)).alias("group_size")
        )

    def update(self) -> None:
        """Take in all files that are not in the state yet."""
        schema = self.spark.read.parquet(self.path).schema
        reader = self.spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE)
        if self.files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        # as a pattern the path may name one file as well as a folder
        source = f"{self.path[:-1]}[{self.path[-1]}]"
        updates = f"{self.root}/updates"
        self.spark.createDataFrame([], _GROUP).write.mode("overwrite").parquet(f"{updates}/batch=-1")

        def store(batch: DataFrame, number: int) -> None:
            # a batch that is run again replaces its own folder
            batch.write.mode("overwrite").parquet(f"{updates}/batch={number}")

        before = {key: self.spark.conf.get(key, None) for key in _SETTINGS}
        for key, value in _SETTINGS.items():
            self.spark.conf.set(key, value)
        try:
            query = (
                self._grouped(self._rows(reader.parquet(source)), "digest")
                .writeStream.outputMode("update")
                .option("checkpointLocation", f"{self.root}/state")
                .trigger(availableNow=True)
                .foreachBatch(store)
                .start()
            )
            query.awaitTermination()
        finally:
            for key, value in before.items():
                if value is None:
                    self.spark.conf.unset(key)
                else:
                    self.spark.conf.set(key, value)

    def groups(self) -> DataFrame:
        """The state's last word on each digest: ``digest, keep, group_size``."""
        updates = self.spark.read.schema(_GROUP).parquet(f"{self.root}/updates")
        return updates.groupBy("digest").agg(
            F.min("keep").alias("keep"), F.max("group_size").alias("group_size")
        )

    def result(self) -> DataFrame:
        """One row for each row of the table: ``id, keep_id, group_size, kept,
        digest`` and the locator ``file, row``.

        Fails if the state does not hold exactly the rows of the table."""
        groups = materialize(self.spark, self.groups(), "groups")
        held = groups.agg(F.sum("group_size")).first()[0] or 0
        there = self.spark.read.parquet(self.path).count()
        if held != there:
            raise ValueError(f"the state holds {held} rows, the table {there}; call update() after adding files")
        members = self._scan(normalise(F.col(self.text_col)).alias("content")).join(
            groups.where("group_size > 1"), "digest"
        )
        is_keep = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
        members = materialize(
            self.spark,
            members.select("digest", "id", "n_chars", "file", "row", "content", is_keep.alias("kept")),
            "members",
        )
        kept = members.where("kept").select("digest", F.col("content").alias("kept_content"))
        # full bytes of every hit against the content that stays; the join splits hot digests
        differ = members.where("NOT kept").join(kept, "digest").where("content != kept_content")
        # grouped only once it is written: a grouping here would keep a hot digest in one task
        differ = materialize(self.spark, differ.select("digest"), "collisions").distinct()
        unknown = F.raise_error(F.concat(F.lit("no group for the digest "), "digest")).cast("long")
        rows = self._scan().join(groups, "digest", "left").withColumn(
            "group_size", F.coalesce("group_size", unknown))
        if differ.isEmpty():
            return self._decided(rows)
        mixed = members.join(differ, "digest", "left_semi")
        regrouped = self._grouped(mixed, "digest", "content")
        mixed = mixed.join(regrouped, ["digest", "content"])
        rows = rows.join(differ, "digest", "left_anti")
        return self._decided(rows).unionByName(self._decided(mixed))

    @staticmethod
    def _decided(rows: DataFrame) -> DataFrame:
        is_keep = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
        return rows.select(
            "id", F.col("keep.id").alias("keep_id"), "group_size", is_keep.alias("kept"),
            "digest", "file", "row",
        )
