"""Query op8: exact duplicates among all documents, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.exactdedup import ExactDedup
from starload.session import table_path


def op8_exactdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dedup = ExactDedup(spark, table_path(sf_dir, "documents"))
    dedup.update()
    return dedup.result().select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.col("digest").alias("text_sha256"),
    )


OP8_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(length(text), 0) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
ranked AS (
  SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size
  FROM docs WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM ranked
"""
