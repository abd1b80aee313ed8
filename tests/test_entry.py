"""The driver contract: every registered query runs on the smallest tables and
agrees with its DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from starload.plans import registry  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
# queries whose result has no SQL equivalent (checked for rows only)


def _norm(rows):
    def cell(v):
        return round(v, 6) if isinstance(v, float) else v
    return sorted((tuple(cell(v) for v in r) for r in rows),
                  key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["company", "counterparty", "contract", "nomenclature",
                          "total_quantity", "total_amount"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLES)
    assert set(registry.QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, oracle, name):
    df = entry_module.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    res = oracle.execute(entry_module.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    expected = [tuple(r[cols.index(c)] for c in df.columns) for r in res.fetchall()]
    assert _norm(rows) == _norm(expected)


@pytest.mark.parametrize("name", ["sales_report", "clean_text", "parse_number", "parse_date",
                                  "date_dimension", "resolve_facts", "upsert_type1"])
def test_plans_stay_in_the_jvm(spark, name):
    """No Python UDF (row-wise or Arrow) in the physical plan."""
    df = entry_module.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan


def test_the_flagship_filter_reaches_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # else the list is cut off
    plan = entry_module.queries()["sales_report"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_linestatus" in line)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = scan[scan.index("PushedFilters"):]
    assert "EqualTo(l_linestatus,O)" in pushed and "EqualTo(l_returnflag,R)" in pushed


def test_the_plan_report_looks_up_once(spark):
    joins = [entry_module.queries()[q](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().count("Join ")
             for q in ("plan_report", "plan_report_sql")]
    assert joins[0] == joins[1]
