"""Query op7: all documents without passages of earlier ones, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import substrings
from starload.session import read_table


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    cut = substrings.remove_repeats(spark, docs)
    return cut.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP7_SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + {substrings.WINDOW - 1}], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - {substrings.WINDOW - 1})) AS i
        FROM docs WHERE len(w) >= {substrings.WINDOW})),
least AS (SELECT h, min(doc_id) AS lo FROM windows GROUP BY h HAVING min(doc_id) <> max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + {substrings.WINDOW - 1})) AS pos
  FROM windows JOIN least USING (h) WHERE doc_id > lo),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.pos) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY words.doc_id)
SELECT docs.doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""
