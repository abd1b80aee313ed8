"""Query op9: documents in 24 shards, with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import sharding
from starload.session import read_table

SHARDS = 24
SEED = 20240


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    keys = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    placed = sharding.shard(spark, docs, keys, SHARDS, SEED)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _round(half: str, k: int) -> str:
    """The round function of one half, as SQL."""
    mul, add = sharding.ROUNDS[k]
    x = f"(({half} % {sharding.PRIME} * {mul} + {add + SEED % sharding.PRIME}) % {sharding.PRIME})"
    return f"(({x} * 48271 + {x} % 65537) % {sharding.PRIME})"


def _network(source: str) -> str:
    """One pass of the network over ``p`` of ``source``, which also has ``n, a, b, num``."""
    at = f"SELECT num, n, a, b, p // b AS l, p % b AS r FROM ({source})"
    for k in range(len(sharding.ROUNDS)):
        left = "l" if k % 2 else f"(l + {_round('r', k)}) % a AS l"
        right = f"(r + {_round('l', k)}) % b AS r" if k % 2 else "r"
        at = f"SELECT num, n, a, b, {left}, {right} FROM ({at})"
    return f"SELECT num, n, a, b, l * b + r AS p FROM ({at})"


#: The checksum of a text, byte by byte with the polynomial's table.
_CRC = """(SELECT list(t ORDER BY i) AS table_ FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z:
      CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS t FROM range(256) r(i)))"""

OP9_SQL = f"""
WITH RECURSIVE bytes AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(octet_length(encode(text)), 0) + 8 AS size,
         coalesce(hex(encode(text)), '') AS h FROM documents),
sums AS (
  SELECT doc_id, size, CAST(xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2),
           lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))),
           lambda c, x: xor(c // 256, table_[xor(c, x) % 256 + 1])), 4294967295) AS BIGINT) AS text_crc32
  FROM bytes, {_CRC}),
sizes AS (
  SELECT n, a, greatest(1, CAST(ceil(n / a) AS BIGINT)) AS b FROM (
    SELECT count(*) AS n, greatest(1, CAST(ceil(sqrt(count(*))) AS BIGINT)) AS a FROM documents)),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS num FROM sums),
walk AS (
  {_network("SELECT num, n, a, b, num AS p FROM numbered, sizes")}
  UNION ALL
  {_network("SELECT * FROM walk WHERE p >= n")})
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(p % {SHARDS} AS INTEGER) AS shard,
       CAST(p // {SHARDS} AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM numbered JOIN walk USING (num) WHERE p < n
"""
