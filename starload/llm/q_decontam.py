"""Query op2: documents that hold benchmark items, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import decontam as dc
from starload.session import read_table


def op2_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    found = dc.matches(spark, docs, items, id="doc_id")
    return found.select(F.col("id").alias("doc_id"), "item_id", "item_tokens", "matched", "score")


def _lookup(side: str, mask: tuple[int, ...]) -> str:
    words = ", ".join(f"lead(w, {o}) OVER s AS w{i}" for i, o in enumerate(mask))
    return f"SELECT id, pos, {words} FROM {side} WINDOW s AS (PARTITION BY id ORDER BY pos)"


def _hits(mask: tuple[int, ...]) -> str:
    same = " AND ".join(f"d.w{i} = b.w{i}" for i in range(len(mask)))
    return (f"SELECT DISTINCT d.id AS doc_id, b.id AS item_id, d.pos - b.pos AS shift "
            f"FROM ({_lookup('dt', mask)}) d JOIN ({_lookup('bt', mask)}) b ON {same}")


_TOKENS = rf"""regexp_extract_all(regexp_replace(lower(text), '({dc.ALONE})', ' \1 ', 'g'), '[\p{{L}}\p{{N}}]+')"""

OP2_SQL = rf"""
WITH docs AS (SELECT doc_id AS id, {_TOKENS} AS t FROM documents),
items AS (SELECT item_id AS id, {_TOKENS} AS t FROM benchmark),
dt AS (SELECT id, unnest(t) AS w, generate_subscripts(t, 1) AS pos FROM docs),
bt AS (SELECT id, unnest(t) AS w, generate_subscripts(t, 1) AS pos FROM items),
hits AS ({" UNION ".join(_hits(m) for m in dc.MASKS)}
  UNION SELECT d.id, b.id, d.pos - 1 AS shift FROM dt d JOIN bt b ON b.pos = 1 AND d.w = b.w
  JOIN items ON items.id = b.id AND len(items.t) < {dc.MIN_TOKENS}),
points AS (
  SELECT h.doc_id, h.item_id, h.shift, b.pos, CASE WHEN d.w = b.w THEN 1 ELSE -1 END AS p
  FROM hits h JOIN bt b ON b.id = h.item_id
  LEFT JOIN dt d ON d.id = h.doc_id AND d.pos = b.pos + h.shift),
sums AS (
  SELECT *, sum(p) OVER (PARTITION BY doc_id, item_id, shift ORDER BY pos) AS s FROM points),
runs AS (
  SELECT *, s - least(0, coalesce(min(s) OVER (PARTITION BY doc_id, item_id, shift ORDER BY pos
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS run FROM sums),
scored AS (
  SELECT doc_id, item_id, shift, count(*) AS item_tokens, count(*) FILTER (p > 0) AS matched,
         CAST(greatest(0, max(run)) AS BIGINT) AS score
  FROM runs GROUP BY doc_id, item_id, shift)
SELECT doc_id, item_id, max(item_tokens) AS item_tokens, max(matched) AS matched,
       max(score) FILTER (matched = top) AS score
FROM (SELECT *, max(matched) OVER (PARTITION BY doc_id, item_id) AS top FROM scored
      WHERE CASE WHEN item_tokens < {dc.MIN_TOKENS} THEN matched = item_tokens
            ELSE score >= least({dc.MIN_SCORE}, ceil(item_tokens * {dc.SHORT_SHARE}))
                 OR matched >= item_tokens * {dc.MIN_SHARE} END)
GROUP BY doc_id, item_id
"""
