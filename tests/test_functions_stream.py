import pytest
from pyspark.sql import functions as F

from starload.functions.sql_functions import (
    PLAN_MET,
    PLAN_NOT_MET,
    filter_table_dynamic,
    register_filter_table,
)
from starload.plans.plan_fact import plan_report, plan_report_sql, plan_with_fact
from starload.sinks.files import export_split
from starload.streaming.ingest import batch_report, ingest_chunks, ingest_rows, read_ingested, type_sales_chunk


def _plan_fact(spark):
    plan = spark.createDataFrame([(1, "m1", 10), (2, "m2", 20), (3, "m3", 30)],
                                 "id bigint, manager string, val_plan bigint")
    fact = spark.createDataFrame([(1, "m1", 15), (2, "m2", 19), (3, "m3", 35)],
                                 "id bigint, manager string, val_fact bigint")
    return plan, fact


def test_plan_fact_golden(spark):
    plan, fact = _plan_fact(spark)
    got = sorted(tuple(r) for r in plan_with_fact(plan, fact).collect())
    assert got == [(1, "m1", 10, 15, PLAN_MET), (2, "m2", 20, 19, PLAN_NOT_MET),
                   (3, "m3", 30, 35, PLAN_MET)]


def test_sql_table_function_equals_dataframe_twin(spark):
    plan, fact = _plan_fact(spark)
    for verdict in (PLAN_MET, PLAN_NOT_MET):
        a = sorted(tuple(r) for r in plan_report(plan, fact, verdict).collect())
        b = sorted(tuple(r) for r in plan_report_sql(spark, plan, fact, verdict).collect())
        assert a == b


def test_missing_fact_is_not_met(spark):
    plan, fact = _plan_fact(spark)
    got = plan_with_fact(plan, fact.where("id <> 2")).where("id = 2").first()
    assert got["val_fact"] is None and got["result"] == PLAN_NOT_MET


def test_table_function_and_dynamic_filter(spark):
    spark.createDataFrame([(i, f"m{i}", v) for i, v in enumerate([10, 20, 10, 40, 50], 1)],
                          "id bigint, manager string, val bigint").createOrReplaceTempView("sales_tf")
    register_filter_table(spark, "filter_sales", "sales_tf", "val", [("id", "BIGINT"), ("manager", "STRING"), ("val", "BIGINT")])
    a = sorted(tuple(r) for r in spark.sql("SELECT * FROM filter_sales(10)").collect())
    b = sorted(tuple(r) for r in filter_table_dynamic(
        spark, "SELECT * FROM sales_tf WHERE val = :v", v=10).collect())
    assert a == b == [(1, "m1", 10), (3, "m3", 10)]


def test_stream_ingest_equals_batch_and_restart_adds_nothing(spark, tmp_dir):
    rows = spark.range(0, 90).select(
        F.format_string("%d.%d.2016", (F.col("id") % 28 + 1).cast("int"), F.lit(1)).alias("dt"),
        (F.col("id") % 7).cast("string").alias("client"),
        (F.col("id") % 5).cast("string").alias("product"),
        (F.col("id") * 10).cast("string").alias("amount"),
    )
    export_split(rows.repartition(3), f"{tmp_dir}/in", 10)
    ingest_chunks(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", files_per_batch=2)
    report = batch_report(spark, f"{tmp_dir}/out").collect()
    assert sum(r["rows"] for r in report) == 90 and len(report) >= 2
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.count() == 90 and out.agg(F.sum("amount")).first()[0] == sum(range(90)) * 10
    ingest_chunks(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", files_per_batch=2)
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 90


def test_more_than_a_hundred_batches_are_all_reported(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/in")
    for i in range(103):
        with open(f"{tmp_dir}/in/{i:03d}.csv", "w", encoding="utf-8") as f:
            f.write(f"dt,c,p,s\n1.1.2016,1,2,3\n{'oops' if i == 50 else '2.1.2016'},1,2,3\n")
    ingest_chunks(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt")
    report = batch_report(spark, f"{tmp_dir}/out").collect()
    assert len(report) == 103 and {r["rows"] for r in report} == {2}
    assert sum(r["bad_dates"] for r in report) == 1


def test_table_function_with_a_decimal_column(spark):
    spark.createDataFrame([(1, "5.25"), (2, "6.50")], "id bigint, v string").select(
        "id", F.col("v").cast("decimal(10,2)").alias("v")).createOrReplaceTempView("dec_t")
    register_filter_table(spark, "dec_f", "dec_t", "id", [("id", "BIGINT"), ("v", "DECIMAL(10,2)")])
    assert [str(r["v"]) for r in spark.sql("SELECT v FROM dec_f(2)").collect()] == ["6.50"]


def _sales_lines(path, first, n):
    with open(path, "w", encoding="utf-8") as f:
        f.write("dt,c,p,s\n" + "".join(f"{i % 28 + 1}.1.2016,{i % 7},{i % 5},{i}\n" for i in range(first, first + n)))


def _uncommit(checkpoint):
    """As if the driver had been lost between the last batch and its commit."""
    from pathlib import Path

    last = max((p for p in Path(checkpoint, "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    return int(last.name)


def test_one_file_comes_in_batches_of_n_rows_with_ids_that_go_on(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/in")
    _sales_lines(f"{tmp_dir}/in/a.csv", 0, 1050)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # the file is read by several tasks
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        def run():
            ingest_rows(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", 100, id_col="id")
            rows = {r["id"]: r["amount"] for r in read_ingested(spark, f"{tmp_dir}/out").collect()}
            return rows, batch_report(spark, f"{tmp_dir}/out").collect()

        rows, report = run()
        assert sorted(rows) == list(range(1, 1051)) and sorted(rows.values()) == list(range(1050))
        assert sorted(r["rows"] for r in report) == [50] + [100] * 10
        assert [r["first_id"] for r in report] == [1] + [r["last_id"] + 1 for r in report[:-1]]
        # rows of a chunk keep the file's order
        for r in report:
            amounts = [rows[i] for i in range(r["first_id"], r["last_id"] + 1)]
            assert amounts == list(range(amounts[0], amounts[0] + r["rows"]))
        assert run() == (rows, report)  # a restart adds nothing
        assert _uncommit(f"{tmp_dir}/ckpt/ingest") == 10
        again, told = run()  # the last batch runs again and gives the same ids
        assert again == rows and [r[:3] for r in told] == [r[:3] for r in report]
        _sales_lines(f"{tmp_dir}/in/b.csv", 2000, 120)
        more, told = run()
        assert {i: more[i] for i in rows} == rows and sorted(more) == list(range(1, 1171)) and len(told) == 13
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_ids_of_file_batches_survive_a_forced_rerun(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/in")
    for k in range(5):
        _sales_lines(f"{tmp_dir}/in/{k}.csv", 100 * k, 7 + k)

    def run():
        ingest_chunks(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", files_per_batch=2, id_col="key")
        return sorted((r["key"], r["amount"]) for r in read_ingested(spark, f"{tmp_dir}/out").collect())

    rows = run()
    assert [k for k, _ in rows] == list(range(1, 46))
    _uncommit(f"{tmp_dir}/ckpt")
    assert run() == rows


def test_a_batch_that_fails_before_its_record_gives_the_same_ids(spark, tmp_dir, monkeypatch):
    import os

    from starload.streaming import ingest

    os.makedirs(f"{tmp_dir}/in")
    _sales_lines(f"{tmp_dir}/in/a.csv", 0, 25)
    write = ingest.write_note

    def fail(spark, path, *args, **how):
        if path.endswith("batch-000000001.json"):
            raise RuntimeError("lost")
        write(spark, path, *args, **how)

    with monkeypatch.context() as m:
        m.setattr(ingest, "write_note", fail)
        with pytest.raises(Exception, match="lost"):
            ingest_rows(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", 10, id_col="id")
    before = {r["id"]: r["amount"] for r in read_ingested(spark, f"{tmp_dir}/out").collect()}
    ingest_rows(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", 10, id_col="id")
    after = {r["id"]: r["amount"] for r in read_ingested(spark, f"{tmp_dir}/out").collect()}
    assert sorted(after) == list(range(1, 26)) and {i: after[i] for i in before} == before


def test_the_load_procedure_as_a_script(spark):
    from starload.functions.procedures import replace_range_script

    spark.sql("CREATE TABLE script_facts (id BIGINT, dt TIMESTAMP_NTZ, v INT, dt_create TIMESTAMP_NTZ, "
              "dt_update TIMESTAMP_NTZ, is_actual BOOLEAN) USING parquet")
    old = "timestamp_ntz'2016-02-01'"
    spark.sql(f"INSERT INTO script_facts VALUES (1, timestamp_ntz'2016-01-12 09:00:00', 1, {old}, {old}, true), "
              f"(2, timestamp_ntz'2016-01-13', 2, {old}, {old}, true), (5, NULL, 3, {old}, {old}, NULL)")
    spark.sql("SELECT timestamp_ntz'2016-01-12 23:59:59' AS dt, CAST(id AS INT) AS v FROM range(20) "
              "UNION ALL SELECT NULL, 7").createOrReplaceTempView("script_new")
    got = {r["id"]: r for r in replace_range_script(
        spark, "script_facts", "script_new", "script_next", "2016-03-01", "replace", "2016-01-12", "2016-01-12").collect()}
    assert sorted(got) == [1, 2, *range(5, 27)]
    assert [got[i]["is_actual"] for i in (1, 2, 5)] == [False, True, None] and got[1]["dt_update"] == got[2]["dt_update"]
    new = [got[i] for i in range(6, 27)]
    assert sorted(r["v"] for r in new) == sorted([*range(20), 7]) and all(r["is_actual"] for r in new)
    assert {str(r["dt_create"]) for r in new} == {"2016-03-01 00:00:00"}
    appended = replace_range_script(spark, "script_next", "script_new", "script_last", "2016-04-01")
    assert appended.count() == 45 and appended.where("id <= 5 AND NOT is_actual").count() == 1


def test_dynamic_text_with_and_without_values(spark):
    spark.range(6).createOrReplaceTempView("dyn")
    assert filter_table_dynamic(spark, "SELECT * FROM dyn").count() == 6
    got = filter_table_dynamic(spark, "SELECT * FROM dyn WHERE id BETWEEN :a AND :b", b=3, a=2).collect()
    assert sorted(r["id"] for r in got) == [2, 3]


def test_many_chunks_share_a_micro_batch_and_keep_their_own_records(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/in")
    _sales_lines(f"{tmp_dir}/in/a.csv", 0, 333)

    def run():
        ingest_rows(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ckpt", 5, id_col="id",
                    transform=lambda df: type_sales_chunk(df).where("amount NOT BETWEEN 100 AND 106"))
        rows = {r["id"]: r["amount"] for r in read_ingested(spark, f"{tmp_dir}/out").collect()}
        return rows, batch_report(spark, f"{tmp_dir}/out").collect()

    rows, report = run()
    assert len(os.listdir(f"{tmp_dir}/ckpt/ingest/commits")) // 2 <= 16  # 67 chunks
    assert sorted(rows) == list(range(1, 327)) and sorted(rows.values()) == [*range(100), *range(107, 333)]
    assert [r["batch_id"] for r in report] == list(range(67))
    assert sorted(r["rows"] for r in report) == [0, 3, 3] + [5] * 64
    given = [r for r in report if r["rows"]]
    assert [r["first_id"] for r in given] == [1] + [r["last_id"] + 1 for r in given[:-1]]
    # a chunk's rows keep the file's order
    for r in given:
        amounts = [rows[i] for i in range(r["first_id"], r["last_id"] + 1)]
        assert amounts == list(range(amounts[0], amounts[0] + r["rows"]))
    _uncommit(f"{tmp_dir}/ckpt/ingest")
    again, told = run()
    assert again == rows and [r[:3] for r in told] == [r[:3] for r in report]


def test_the_script_returns_a_table_and_not_collected_rows(spark):
    from starload.functions.procedures import replace_range_script

    spark.sql("SELECT id, timestamp_ntz'2016-01-12' AS dt, 1 AS v, timestamp_ntz'2016-02-01' AS dt_create, "
              "timestamp_ntz'2016-02-01' AS dt_update, true AS is_actual FROM range(1, 4)").write.saveAsTable("lean_facts")
    spark.sql("SELECT timestamp_ntz'2016-01-13' AS dt, 2 AS v").createOrReplaceTempView("lean_new")
    got = replace_range_script(spark, "lean_facts", "lean_new", "lean_next", "2016-03-01")
    assert got.inputFiles() and sorted(r["id"] for r in got.collect()) == [1, 2, 3, 4]
