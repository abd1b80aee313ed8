"""From raw documents to a shuffled, sharded training mix, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` with ``docs`` a written table, works
on all rows of it and returns a DataFrame; all but the last return the columns
of ``documents``.  A null, empty or repeated value in any column is handled as
the operators' docstrings say; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import decontam, langid, minhash, mixing, sharding
from starload.llm.common import materialize, n_words
from starload.session import read_table

SHARDS = 24

#: Words in a shingle of the near-duplicate stage.
SHINGLE = 5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; what has no letter or no lead goes."""
    model = langid.fit(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    return langid.accept(spark, docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.first_of_each(spark, docs, "doc_id", "text", SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.clean(spark, docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights take them."""
    labels = read_table(spark, sf_dir, "labels")
    return mixing.mixed(spark, docs, labels, n_words(F.col("text")), "doc_id", "source")


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and their slot in it."""
    keys = [F.col("doc_id"), F.xxhash64("text")]
    return sharding.shard(spark, docs, keys, SHARDS)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shards", shards),
]

#: SQL cannot express the compression and the signatures; the stages are tested
#: against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
