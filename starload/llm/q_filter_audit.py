"""Query op13: what five filters remove in every order, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.llm import filter_audit
from starload.session import read_table


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    return filter_audit.documents_audit(spark, docs, labels)


_LETTERS = "(SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x)"

OP13_SQL = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
failing AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
      || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
      || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
      || CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 'E' ELSE '' END AS mask
  FROM docs),
marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, mask, coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS toxic, count(*) AS n
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY ALL),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o
  FROM {_LETTERS} a, {_LETTERS} b, {_LETTERS} c, {_LETTERS} d, {_LETTERS} e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT o, s, substr(o, s, 1) AS x FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS s)),
gone AS (
  SELECT masks.*, o, coalesce(list_min(list_filter([1, 2, 3, 4, 5], lambda k: contains(mask, substr(o, k, 1)))), 6) AS g
  FROM masks, orders),
counts AS (
  SELECT part, o, s, x,
         sum(CASE WHEN g > s THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN g = s THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN g < s AND contains(mask, x) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = x THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN g = s AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN g = s AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM gone JOIN steps USING (o) GROUP BY part, o, s, x)
SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, x AS filter,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counts
"""
