"""Query op11: the ten best documents for every benchmark item, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import lexical
from starload.session import read_table


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    items = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text")
    return lexical.search(spark, docs, items)


_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = f"""
WITH docs AS (
  SELECT doc_id, t, CAST(len(t) AS BIGINT) AS n FROM (
    SELECT doc_id, {_TERMS.format(_LOWER)} AS t FROM documents) WHERE len(t) > 0),
asked AS (
  SELECT item_id, w, count(*) AS times FROM (
    SELECT item_id, unnest({_TERMS.format(_LOWER)}) AS w FROM benchmark) GROUP BY ALL),
facts AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM docs),
tfs AS (
  SELECT doc_id, n, w, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc_id, n, unnest(t) AS w FROM docs)
  WHERE w IN (SELECT w FROM asked) GROUP BY ALL),
weights AS (
  SELECT w, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM (SELECT w, count(*) AS df FROM tfs GROUP BY w), facts),
scores AS (
  SELECT item_id, doc_id,
         CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))
              AS BIGINT) AS score
  FROM asked JOIN tfs USING (w) JOIN weights USING (w), facts GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
