"""Query op1: near duplicates among all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import minhash
from starload.session import read_table

#: Words in a shingle of this query.
SHINGLE = 2


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    found = minhash.near_duplicates(spark, docs, k=SHINGLE)
    return found.select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
