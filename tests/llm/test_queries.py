"""The registered corpus queries against their SQL, or a plain version."""

import zlib
from collections import defaultdict

import duckdb
import pytest

from starload.llm.queries import ORACLES, QUERIES
from starload.session import read_table

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda t: tuple((v is not None, str(v)) for v in t))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF)
    result = oracle.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = [tuple(r[columns.index(c)] for c in df.columns) for r in result.fetchall()]
    assert _sorted(map(tuple, df.collect())) == _sorted(want)


def test_shards_of_the_documents(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    got = QUERIES["op9_sharding"](spark, SF).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    slots = defaultdict(list)
    for r in got:
        data = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
