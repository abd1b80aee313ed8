from pyspark.sql import functions as F

from starload.operators.aggregates import profile, row_count, sum_by
from starload.operators.joins import left_lookup, orphans, scalar_lookup
from starload.operators.quality import (
    check_decimal,
    check_length,
    check_not_null,
    check_unique,
)
from starload.operators.setops import top_n, union_all


def _fact(spark):
    return spark.createDataFrame(
        [(1, "a", "x", 10), (2, "b", "y", 20), (3, None, "x", 30), (4, "z", "x", 40)],
        "id int, name string, kind string, v int",
    )


def test_left_lookup_keeps_unmatched_and_fans_out(spark):
    dim = spark.createDataFrame([("a", 100), ("b", 200), ("b", 201), (None, 999)],
                                "name string, dim_id int")
    out = left_lookup(_fact(spark), dim, "name", {"dim_id": "dim_id"})
    rows = sorted((r["id"], r["dim_id"]) for r in out.collect())
    # b matches twice, NULL never matches, z is kept with NULL
    assert rows == [(1, 100), (2, 200), (2, 201), (3, None), (4, None)]


def test_composite_lookup(spark):
    dim = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("z", "x", 3)],
                                "n string, k string, cid int")
    out = left_lookup(_fact(spark), dim, [("name", "n"), ("kind", "k")], {"cid": "cid"})
    assert sorted((r["id"], r["cid"]) for r in out.collect()) == [
        (1, 1), (2, None), (3, None), (4, 3)]


def test_scalar_lookup_never_fans_out(spark):
    dim = spark.createDataFrame([(1, 5), (1, 7), (2, 3)], "id int, val int")
    out = scalar_lookup(_fact(spark), dim, "id", "val")
    assert sorted((r["id"], r["val"]) for r in out.collect()) == [(1, 7), (2, 3), (3, None), (4, None)]


def test_orphans_pass_null_children(spark):
    parent = spark.createDataFrame([("a",), ("b",)], "name string")
    got = sorted(r["id"] for r in orphans(_fact(spark), parent, "name").collect())
    assert got == [4]


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [(1, "abcdef", 12345678.9), (1, "ab", None), (2, None, 123456789.0)],
        "k int, s string, d double")
    nulls = {r["column_name"]: r["null_count"] for r in check_not_null(df, df.columns).collect()}
    assert nulls == {"k": 0, "s": 1, "d": 1}
    assert check_length(df, {"s": 5}).count() == 1
    assert [tuple(r) for r in check_unique(df, ["k"]).collect()] == [(1, 2)]
    assert [r["k"] for r in check_decimal(df, ["d"]).collect()] == [2]


def test_profile_row_count_sum_top_union(spark):
    df = _fact(spark)
    prof = {r["column_name"]: (r["data_type"], r["non_null"]) for r in profile(df).collect()}
    assert prof == {"id": ("int", 4), "name": ("string", 3), "kind": ("string", 4), "v": ("int", 4)}
    assert row_count(df).first()[0] == 4
    sums = {r["kind"]: r["total"] for r in sum_by(df, ["kind"], {"v": "total"}).collect()}
    assert sums == {"x": 80, "y": 20}
    assert [r["id"] for r in top_n(df, 2, [F.col("v").desc()]).collect()] == [4, 3]
    assert union_all([df, df]).count() == 8


def test_sales_star_schema_constraints(spark):
    """The managers / regions / products / sales star: declared constraints
    become checks (unique names of at most 255 characters, NOT NULL, foreign
    keys, NUMERIC(10,2))."""
    from decimal import Decimal

    from starload.sinks.tables import create_tables

    managers = spark.createDataFrame([(1, "m1", None), (2, "m2", "x"), (3, "m2", None)],
                                     "id int, manager_name string, description string")
    regions = spark.createDataFrame([(1, "r" * 256, None)], "id int, region_name string, description string")
    sales = spark.createDataFrame(
        [(1, 1, 1, Decimal("10.00"), 2, Decimal("20.00")),
         (2, 9, 1, Decimal("123456789.00"), 1, None)],
        "id int, manager_id int, region_id int, unit_price decimal(20,2), quantity int, "
        "amount decimal(20,2)")
    assert [r["manager_name"] for r in check_unique(managers, ["manager_name"]).collect()] == ["m2"]
    assert check_length(regions, {"region_name": 255}).count() == 1
    assert [r["id"] for r in orphans(sales, managers, {"manager_id": "id"}).collect()] == [2]
    assert [r["id"] for r in check_decimal(sales, ["unit_price", "amount"]).collect()] == [2]
    nulls = {r["column_name"]: r["null_count"] for r in check_not_null(sales, ["amount"]).collect()}
    assert nulls == {"amount": 1}

    # the same declarations as DDL: NUMERIC(10,2) rounds, VARCHAR(n) is enforced on write
    create_tables(spark, {"star_products": "id INT, product_name VARCHAR(5), price DECIMAL(10,2)"})
    spark.sql("INSERT INTO star_products VALUES (1, 'pr1', 1.005)")
    assert spark.table("star_products").first()["price"] == Decimal("1.01")
    try:
        spark.sql("INSERT INTO star_products VALUES (2, 'too long', 1.0)")
        raised = False
    except Exception:
        raised = True
    assert raised
