"""Query op3: the language of every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import langid
from starload.session import read_table


def held_out() -> Column:
    return (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4) == 2


def fit_on(docs: DataFrame) -> langid.Model:
    """A model from the labels of documents that are not held out."""
    return langid.fit(docs.where(~held_out()).select(F.col("doc_id").alias("id"), "text", "lang"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    told = langid.identify(spark, docs.select("doc_id", "text"), fit_on(docs))
    return told.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "second", "accepted")
