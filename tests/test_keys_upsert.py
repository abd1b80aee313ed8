import datetime as dt

import pytest
from pyspark.sql import functions as F

from starload.operators.keys import assign_keys
from starload.operators.quality import ConstraintViolation
from starload.operators.upsert import expire_unseen, initial_load, replace_range, upsert

T1 = "2024-01-01 00:00:00"
T2 = "2024-02-01 00:00:00"


def test_assign_keys_dense_ordered_and_continuing(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"))
    keyed = assign_keys(df, ["k"], start=100, num_partitions=7)
    rows = keyed.orderBy("k").collect()
    assert [r["id"] for r in rows] == list(range(101, 5101))
    assert [r["k"] for r in rows] == list(range(5000))


def test_assign_keys_empty(spark):
    df = spark.range(0).select(F.col("id").alias("k"))
    assert assign_keys(df, ["k"]).count() == 0


def _target(spark):
    src = spark.createDataFrame(
        [("a", "x1"), ("b", "x2"), ("c", "x3")], "name string, attr string"
    )
    dim = initial_load(src, ["name", "attr"], T1)
    # "c" was expired by an earlier load
    return dim.withColumn("is_actual", F.col("name") != "c")


def test_upsert_touch_insert_and_expire(spark):
    target = _target(spark)
    source = spark.createDataFrame([("a", "new"), ("c", "y"), ("d", "z")], "name string, attr string")
    out = expire_unseen(upsert(target, source, ["name"], T2), T2)
    rows = {r["name"]: r for r in out.collect()}
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    # matched: only dt_update moves; attributes untouched without update_cols
    assert (rows["a"]["attr"], rows["a"]["dt_update"], rows["a"]["is_actual"]) == ("x1", t2, True)
    # unseen: expired
    assert (rows["b"]["dt_update"], rows["b"]["is_actual"]) == (t1, False)
    # expired and seen again: stays expired
    assert (rows["c"]["dt_update"], rows["c"]["is_actual"]) == (t2, False)
    # new: next id, both stamps = load
    assert (rows["d"]["id"], rows["d"]["dt_create"], rows["d"]["is_actual"]) == (4, t2, True)


def test_upsert_type1_overwrites_with_null(spark):
    target = _target(spark)
    source = spark.createDataFrame([("a", None), ("b", "q")], "name string, attr string")
    out = upsert(target, source, ["name"], T2, update_cols=["attr"])
    rows = {r["name"]: r["attr"] for r in out.collect()}
    assert rows == {"a": None, "b": "q", "c": "x3"}


def test_upsert_rejects_duplicate_source_keys(spark):
    target = _target(spark)
    source = spark.createDataFrame([("a", "1"), ("a", "2")], "name string, attr string")
    with pytest.raises(ConstraintViolation):
        upsert(target, source, ["name"], T2).collect()


def test_upsert_inserts_repeated_keys_without_a_target_row(spark):
    target = _target(spark)
    source = spark.createDataFrame([("a", "1"), ("n", "2"), ("n", "3")], "name string, attr string")
    out = upsert(target, source, ["name"], T2).collect()
    assert sorted(r["attr"] for r in out if r["name"] == "n") == ["2", "3"]
    assert len({r["id"] for r in out}) == len(out)


def test_ids_without_an_order(spark):
    from starload.operators.keys import assign_keys_unordered

    df = spark.range(0, 1000).withColumn("v", F.lit(1)).repartition(7)
    keyed, last = assign_keys_unordered(df.drop("id").withColumn("w", F.lit(2)), start=50)
    assert last == 1050 and sorted(r["id"] for r in keyed.collect()) == list(range(51, 1051))
    empty, last = assign_keys_unordered(df.where("id < 0").drop("id"), start=3)
    assert last == 3 and empty.collect() == []


def test_empty_source_expires_everything(spark):
    target = _target(spark)
    source = spark.createDataFrame([], "name string, attr string")
    out = expire_unseen(upsert(target, source, ["name"], T2), T2)
    assert out.where("is_actual").count() == 0


def _fact(spark):
    rows = [(1, dt.datetime(2016, 1, 11, 23, 59, 59), 10), (2, dt.datetime(2016, 1, 12, 0, 0), 20),
            (3, dt.datetime(2016, 1, 13, 23, 59, 59), 30), (4, dt.datetime(2016, 1, 14, 0, 0), 40)]
    df = spark.createDataFrame(rows, "id long, dt timestamp_ntz, amount int")
    return df.select("*", F.lit(T1).cast("timestamp_ntz").alias("dt_create"),
                     F.lit(T1).cast("timestamp_ntz").alias("dt_update"), F.lit(True).alias("is_actual"))


def test_replace_range_inclusive_days(spark):
    fact = _fact(spark)
    new = spark.createDataFrame([(dt.datetime(2016, 1, 12, 8, 0), 99)], "dt timestamp_ntz, amount int")
    out = replace_range(fact, new, T2, mode="replace", start="2016-01-12", end="2016-01-13")
    rows = {r["id"]: r for r in out.collect()}
    assert [rows[i]["is_actual"] for i in (1, 2, 3, 4, 5)] == [True, False, False, True, True]
    assert rows[2]["dt_update"] == dt.datetime(2024, 1, 1)
    assert rows[5]["amount"] == 99


def test_append_mode_is_not_idempotent(spark):
    fact = _fact(spark)
    new = spark.createDataFrame([(dt.datetime(2016, 1, 12, 8, 0), 99)], "dt timestamp_ntz, amount int")
    once = replace_range(fact, new, T2)
    twice = replace_range(once, new, T2)
    assert twice.where("amount = 99").count() == 2
    assert twice.where("is_actual").count() == 6


def test_assign_keys_large_path_with_hot_key(spark):
    # a third of the rows share one key value; ties are split by the other columns
    df = spark.range(0, 30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 13 % 30_000).alias("v"),
    )
    keyed = assign_keys(df.repartition(5), ["k"], start=10, num_partitions=6)
    rows = keyed.collect()
    assert sorted(r["id"] for r in rows) == list(range(11, 30_011))
    ordered = sorted(rows, key=lambda r: r["id"])
    assert [(r["k"], r["v"]) for r in ordered] == sorted((r["k"], r["v"]) for r in rows)
    sizes = keyed.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 1


def test_replace_range_hard_delete_variant(spark):
    fact = _fact(spark)
    new = spark.createDataFrame([(dt.datetime(2016, 1, 12, 8, 0), 99)], "dt timestamp_ntz, amount int")
    out = replace_range(fact, new, T2, mode="replace", start="2016-01-12", end="2016-01-13",
                        delete=True)
    assert sorted(r["id"] for r in out.collect()) == [1, 4, 5]
    assert out.where("is_actual").count() == 3
