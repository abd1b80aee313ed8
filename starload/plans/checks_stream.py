"""Streaming ingest checks: line items exported as dated CSV chunks, ingested
a few files per micro-batch, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.session import read_table, scratch_path
from starload.sinks.files import export_one, export_split
from starload.streaming.ingest import batch_report, ingest_chunks, ingest_rows, read_ingested

CHUNK_ROWS = 50_000
FILES_PER_BATCH = 2


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem")
    return lineitem.select(
        F.date_format("l_shipdate", "d.M.yyyy").alias("date"),
        F.col("l_suppkey").cast("string").alias("client"),
        F.col("l_partkey").cast("string").alias("product"),
        F.round("l_extendedprice").cast("bigint").cast("string").alias("sum"),
    )


def _run(spark: SparkSession, sf_dir: str):
    chunks = _texts(spark, sf_dir)
    in_dir = scratch_path(spark, "chunks-in")
    export_split(chunks, in_dir, CHUNK_ROWS)
    out = scratch_path(spark, "chunks-out")
    ingest_chunks(spark, in_dir, out, scratch_path(spark, "chunks-ckpt"), FILES_PER_BATCH)
    return out


def ingest_chunks_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_ingested(spark, _run(spark, sf_dir))


INGEST_CHUNKS_SQL = """
SELECT CAST(l_shipdate AS DATE) AS dt, CAST(l_suppkey AS INTEGER) AS client_id,
       CAST(l_partkey AS INTEGER) AS product_id, CAST(ROUND(l_extendedprice) AS INTEGER) AS amount
FROM lineitem
"""


def chunk_batches_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of all micro-batches: their rows add up to the table, none
    has more rows than its files may hold, and no date was bad."""
    return batch_report(spark, _run(spark, sf_dir)).agg(
        F.sum("rows").alias("total_rows"),
        F.count_if(F.col("rows") > FILES_PER_BATCH * CHUNK_ROWS).alias("batches_over_limit"),
        F.sum("bad_dates").alias("bad_dates"),
    )


CHUNK_BATCHES_SQL = """
SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS batches_over_limit,
       CAST(count(*) FILTER (l_shipdate IS NULL) AS BIGINT) AS bad_dates
FROM lineitem
"""


BATCH_ROWS = 20_000


def _run_rows(spark: SparkSession, sf_dir: str) -> str:
    """All line items as one file, ingested in batches of at most 20,000 rows with
    ids that go on from batch to batch; then once more, which adds nothing."""
    in_dir, out, checkpoint = (scratch_path(spark, f"rows-{name}") for name in ("in", "out", "ckpt"))
    export_one(_texts(spark, sf_dir), in_dir)
    for _ in range(2):
        ingest_rows(spark, in_dir, out, checkpoint, BATCH_ROWS, id_col="id")
    return out


def ingest_rows_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the one large file, once."""
    return read_ingested(spark, _run_rows(spark, sf_dir)).drop("id")


def batch_ids_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids in the table and the records of the batches: dense and unique over
    all batches, and no batch above its rows."""
    out = _run_rows(spark, sf_dir)
    ids = read_ingested(spark, out).agg(
        F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.count("id").alias("ids"),
        F.count_distinct("id").alias("different_ids"))
    records = batch_report(spark, out).agg(
        F.count(F.lit(1)).alias("batches"), F.max("rows").alias("largest_batch"),
        F.sum(F.col("last_id") - F.col("first_id") + 1).alias("ids_in_records"))
    return ids.join(records)  # one row each


BATCH_IDS_SQL = f"""
SELECT CAST(1 AS BIGINT) AS first_id, count(*) AS last_id, count(*) AS ids, count(*) AS different_ids,
       (count(*) + {BATCH_ROWS - 1}) // {BATCH_ROWS} AS batches, least(count(*), {BATCH_ROWS}) AS largest_batch,
       count(*) AS ids_in_records
FROM lineitem
"""
