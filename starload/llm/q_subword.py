"""Query op12: the quality of every document, as the labels mark it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import subword
from starload.session import read_table


def held_out() -> Column:
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3) == 1


def fit_on(spark: SparkSession, docs: DataFrame, labels: DataFrame, **training) -> subword.Model:
    """A model from the labels of documents that are not held out."""
    return subword.fit(
        spark,
        docs.select(F.col("doc_id").alias("id"), "text"),
        labels.where(~held_out()).select(F.col("doc_id").alias("id"), F.col("quality").alias("label")),
        **training,
    )


def op12_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_on(spark, docs, read_table(spark, sf_dir, "labels"))
    scored = subword.score(spark, docs, model, 1)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
