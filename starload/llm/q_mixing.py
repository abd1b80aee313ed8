"""Query op6: a mix of all documents, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.llm import mixing
from starload.llm.common import n_words
from starload.session import read_table

SEED = 7


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    sized = docs.select(docs.doc_id.alias("id"), "source", n_words(docs.text).alias("size"))
    quality = mixing.quality_of(read_table(spark, sf_dir, "labels"))
    mixed = mixing.mix(spark, sized.join(quality, "id", "left"), seed=SEED)
    return mixed.select(mixed.id.alias("doc_id"), "size", "source_size", "target", "taken")


OP6_SQL = rf"""
WITH best AS (
  SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
docs AS (
  SELECT d.doc_id, d.source,
         CAST(coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5(concat('{SEED}:', coalesce(CAST(d.doc_id AS VARCHAR), 'null'))), 1, 13) AS BIGINT) + 0.5)
             / CAST(4503599627370496 AS DOUBLE))
           / (CASE WHEN b.q IS NULL THEN 1.0::DOUBLE WHEN b.q > 0 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END) AS k
  FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
ranked AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
              WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM sizes),
room AS (
  SELECT *, 3 * sum(source_size) OVER () - 4 * coalesce(sum(source_size) OVER w, 0) AS num,
         2 * (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS den,
         row_number() OVER (ORDER BY source_size / weight, source IS NULL, source) AS rn
  FROM ranked
  WINDOW w AS (ORDER BY source_size / weight, source IS NULL, source
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT num, den FROM room WHERE weight * num <= 2 * source_size * den ORDER BY rn LIMIT 1),
targets AS (
  SELECT r.source, r.source_size,
         least(CAST(2 * r.source_size AS DOUBLE),
               coalesce(CAST(r.weight * l.num AS DOUBLE) / CAST(l.den AS DOUBLE),
                        CAST(2 * r.source_size AS DOUBLE))) AS target
  FROM room r LEFT JOIN level l ON true),
summed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN CAST(floor(t.target / t.source_size) AS BIGINT) ELSE 0 END AS epochs,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + least(size, greatest(0,
         CAST(floor(target + 0.5) AS BIGINT) - epochs * source_size - (upto - size))) AS BIGINT) AS taken
FROM summed
"""
