"""Query op10: language-model scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import brown
from starload.session import read_table


def op10_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    scored = brown.score(
        spark, docs.select(F.col("doc_id").alias("id"), (F.crc32(key) % 5 == 1).alias("held"), "text")
    )
    return scored.select(
        F.col("id").alias("doc_id"), F.col("held").alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score",
    )
