import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from starload.plans import checks_io
from starload.sinks.files import bulk_load, export_csv, export_split
from starload.sinks.tables import SnapshotTable, create_table_as, create_tables, truncate_tables
from starload.sources.catalog import register_foreign_table, run_sql
from starload.sources.files import read_delimited, read_delimited_lenient, read_first_column, read_glob
from starload.sources.generate import date_series, expand_template, generate_sales

THREE = StructType([StructField(n, StringType()) for n in ("a", "b", "c")])


def _write(path, text):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_read_delimited_bom_crlf_inner_quotes(spark, tmp_dir):
    p = f"{tmp_dir}/x.txt"
    _write(p, '\ufeffH1\tH2\tH3\r\nООО "Ромашка"\t007\t"a ""q"" b"\r\nx\t\t z\r\n')
    rows = [tuple(r) for r in read_delimited(spark, p, THREE).collect()]
    assert rows == [('ООО "Ромашка"', "007", 'a "q" b'), ("x", None, " z")]


def test_read_first_column_skips_lead_and_header(spark, tmp_dir):
    p = f"{tmp_dir}/n.txt"
    _write(p, "Report\r\nName\tCode\r\nАссорти\t1\r\nБарбарис\t2\r\n")
    assert [r[0] for r in read_first_column(spark, p, "nomenclature").collect()] == [
        "Ассорти", "Барбарис"]


def test_export_csv_round_trip_and_split(spark, tmp_dir):
    df = spark.createDataFrame(
        [(1, 'say "hi", ok', "back\\slash"), (2, None, "x")], "id int, t string, u string")
    export_csv(df, f"{tmp_dir}/csv")
    schema = StructType([StructField("id", IntegerType()), StructField("t", StringType()),
                         StructField("u", StringType())])
    back = sorted(tuple(r) for r in read_delimited(spark, f"{tmp_dir}/csv", schema, sep=",").collect())
    assert back == [(1, 'say "hi", ok', "back\\slash"), (2, None, "x")]
    big = spark.range(0, 2500).select(F.col("id").cast("int").alias("id"), F.lit("v").alias("t"),
                                      F.lit("w").alias("u"))
    export_split(big.repartition(2), f"{tmp_dir}/split", 1000)
    files = read_glob(spark, f"{tmp_dir}/split/*.csv", schema).groupBy(
        F.col("_metadata.file_path")).count().collect()
    assert max(r["count"] for r in files) <= 1000 and sum(r["count"] for r in files) == 2500


def test_bulk_load_one_file_equals_folder(spark, tmp_dir):
    sales = generate_sales(spark, 3000, "2024-01-01").select(
        F.col("dt").cast("string"), "manager", "product", "val")
    one, many = f"{tmp_dir}/one", f"{tmp_dir}/many"
    export_split(sales.coalesce(1), one, 10_000)
    export_split(sales, many, 500)
    schema = "dt string, manager string, product string, val float"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    a = bulk_load(spark, one, st, f"{tmp_dir}/t1").agg(F.sum("val"), F.count("*")).first()
    b = bulk_load(spark, many, st, f"{tmp_dir}/t2").agg(F.sum("val"), F.count("*")).first()
    assert tuple(a) == tuple(b) and a[1] == 3000


def test_generate_sales_ranges(spark):
    df = generate_sales(spark, 20_000, "2024-01-01")
    r = df.agg(F.min("val"), F.max("val"), F.countDistinct("manager"), F.countDistinct("product")).first()
    assert tuple(r) == (100.0, 1000.0, 3, 5)


def test_expand_template_replaces_first_token_only(spark):
    df = spark.createDataFrame([("c_,c_x",)], "city string")
    got = sorted(r[0] for r in expand_template(df, "city", "c_", 3).select("city").collect())
    assert got == ["c_1,c_x", "c_2,c_x", "c_3,c_x"]


def test_many_file_ingest_golden(spark, tmp_dir):
    template = spark.createDataFrame(
        [("c_", f"m{i}", f"pr{i}", i) for i in range(10)], "city string, manager string, product string, val int")
    copies = expand_template(template, "city", "c_", 10)
    export_split(copies.drop("step"), f"{tmp_dir}/files", 10)
    loaded = read_glob(spark, f"{tmp_dir}/files/*.csv",
                       StructType([StructField("city", StringType()), StructField("manager", StringType()),
                                   StructField("product", StringType()), StructField("val", IntegerType())]))
    assert loaded.count() == 100
    assert loaded.where(F.col("city") == "c_1").count() == 10


def test_date_series_inclusive(spark):
    assert date_series(spark, "2024-01-01", "2024-01-31").count() == 31
    assert date_series(spark, "2024-01-01", "2024-01-31", step_days=7).count() == 5


def test_snapshot_versions(spark, tmp_dir):
    t = SnapshotTable(spark, f"{tmp_dir}/snap")
    assert not t.exists()
    t.replace(spark.range(3))
    # a new state computed from the current one can be written while read
    t.replace(t.read().where("id > 0"))
    assert sorted(r[0] for r in t.read().collect()) == [1, 2] and t.current_version() == 2


def test_typed_tables_defaults_truncate_and_ctas(spark):
    create_tables(spark, {"stage_items": "id BIGINT, name VARCHAR(5), "
                                         "is_actual BOOLEAN DEFAULT true"})
    spark.sql("INSERT INTO stage_items (id, name) VALUES (1, 'ab')")
    assert tuple(spark.table("stage_items").first()) == (1, "ab", True)
    truncate_tables(spark, ["stage_items"])
    spark.sql("INSERT INTO stage_items (id, name) VALUES (2, 'cd')")
    assert spark.table("stage_items").count() == 1
    create_table_as(spark, "items_copy", spark.table("stage_items"))
    create_table_as(spark, "items_copy", spark.table("stage_items"))
    assert spark.table("items_copy").count() == 1


def test_foreign_table_and_run_sql(spark, tmp_dir):
    spark.createDataFrame([(1, 2), (3, 4)], "val_1 int, val_2 int").write.parquet(f"{tmp_dir}/remote")
    register_foreign_table(spark, "tbl2", [("val_1", "INT"), ("val_2", "INT")], "parquet",
                           {"path": f"{tmp_dir}/remote"}, rename={"val_1": "a", "val_2": "b"})
    assert [tuple(r) for r in run_sql(spark, "SELECT a, b FROM tbl2 WHERE a = :v", v=3).collect()] == [(3, 4)]


def test_read_first_column_skips_per_file(spark, tmp_dir):
    import os

    os.makedirs(f"{tmp_dir}/sheets")
    _write(f"{tmp_dir}/sheets/a.txt", "\ufeffLead a\r\nName\tCode\r\nx1\t1\r\nx2\t2\r\n")
    _write(f"{tmp_dir}/sheets/b.txt", "Lead b\r\nName\tCode\r\ny1\t1\r\n")
    got = sorted(r[0] for r in read_first_column(spark, f"{tmp_dir}/sheets", "n").collect())
    assert got == ["x1", "x2", "y1"]


def test_snapshot_pointer_is_read_by_another_handle(spark, tmp_dir):
    writer = SnapshotTable(spark, f"{tmp_dir}/snap2")
    writer.replace(spark.range(5))
    writer.replace(spark.range(2))
    reader = SnapshotTable(spark, f"{tmp_dir}/snap2")
    assert reader.current_version() == 2
    assert sorted(r[0] for r in reader.read().collect()) == [0, 1]


def test_versions_survive_a_lost_entry_and_a_second_writer(spark, tmp_dir):
    from starload.sinks.tables import ConcurrentWriteError

    one, two = (SnapshotTable(spark, f"{tmp_dir}/snap3") for _ in range(2))
    one.replace(spark.range(5))
    two.replace(spark.range(2))
    assert one.current_version() == two.current_version() == 2 and one.read().count() == 2
    # a version whose entry was never written is not seen, and not written over
    spark.range(9).write.parquet(f"{tmp_dir}/snap3/v000003-lost")
    one.replace(spark.range(4))
    assert two.read().count() == 4 and spark.read.parquet(f"{tmp_dir}/snap3/v000003-lost").count() == 9
    one.entries.publish("b", 3, path="x")
    with pytest.raises(ConcurrentWriteError):
        two.entries.publish("c", 3, path="y")
    assert one.entries.latest()["path"] == "x"
    # whichever of two writers after the same entry is first, the other one fails
    for number, (first, second) in ((4, ("bbb", "aaa")), (5, ("aaa", "bbb"))):
        one.entries.publish(first, number, path=first)
        with pytest.raises(ConcurrentWriteError):
            two.entries.publish(second, number, path=second)
        assert two.entries.latest()["tag"] == first
    # an entry that is not complete is passed over, and nobody publishes under its number
    _write(f"{tmp_dir}/snap3/_versions/entry-000000007.json", '{"number": 7, "pa')
    assert one.entries.latest()["number"] == 6
    with pytest.raises(ConcurrentWriteError):
        one.entries.publish("ccc", 6, path="z")


def test_period_folders(spark, tmp_dir):
    import datetime as dt

    from starload.sinks.tables import PeriodFolders

    t = PeriodFolders(spark, period="month")
    rows = [(1, dt.datetime(2016, 1, 5), 10), (2, dt.datetime(2016, 2, 5), 20),
            (3, dt.datetime(2016, 3, 5), 30), (4, None, 40)]
    df = spark.createDataFrame(rows, "id long, dt timestamp_ntz, v int")
    folders = t.write(df, f"{tmp_dir}/facts")
    assert sorted(r["id"] for r in t.read(folders, df.schema).collect()) == [1, 2, 3, 4]
    inside, outside = t.overlapping(folders, "2016-02-10", "2016-02-11")
    assert [r["id"] for r in t.read(inside, df.schema).collect()] == [2]
    assert sorted(r["id"] for r in t.read(outside, df.schema).collect()) == [1, 3, 4]
    assert t.read([], df.schema).collect() == []


def test_facts_of_one_date_are_written_by_several_tasks(spark, tmp_dir):
    import glob

    from starload.sinks.tables import PeriodFolders

    df = spark.range(200_000).select("id", F.lit("2016-01-05").cast("timestamp_ntz").alias("dt"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        PeriodFolders(spark).write(df, f"{tmp_dir}/one-date")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(glob.glob(f"{tmp_dir}/one-date/month_start=2016-01-01/*.parquet")) > 1


@pytest.mark.parametrize("multi_line", [False, True])
def test_csv_gives_back_what_it_got(spark, tmp_dir, multi_line):
    values = ["", None, " a", "b ", "  ", 'say "hi"', "a,b", "back\\slash", "\ttab", '"', "''", "\\"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    export_csv(df, f"{tmp_dir}/csv", multi_line=multi_line)
    back = read_delimited(spark, f"{tmp_dir}/csv", df.schema, sep=",", multi_line=multi_line)
    assert [r["v"] for r in back.orderBy("id").collect()] == values
    lines = spark.createDataFrame([(1, "two\nlines")], "id int, v string")
    if not multi_line:
        with pytest.raises(Exception, match="(?i)malformed|line end"):
            export_csv(lines, f"{tmp_dir}/csv2")
    else:
        export_csv(lines, f"{tmp_dir}/csv2", multi_line=True)
        back = read_delimited(spark, f"{tmp_dir}/csv2", df.schema, sep=",", multi_line=True)
        assert [tuple(r) for r in back.collect()] == [(1, "two\nlines")]


def test_malformed_lines_raise_or_are_kept_apart(spark, tmp_dir):

    _write(f"{tmp_dir}/bad.csv", "a,b\n1,x\n2,y,z\nq,w\n3\n4,v\n")
    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType())])
    with pytest.raises(Exception, match="(?i)malformed|line end"):
        read_delimited(spark, f"{tmp_dir}/bad.csv", schema, sep=",").collect()
    good, bad = read_delimited_lenient(spark, f"{tmp_dir}/bad.csv", schema, sep=",")
    assert sorted(tuple(r) for r in good.collect()) == [(1, "x"), (4, "v")]
    assert sorted(r["_rejected"] for r in bad.collect()) == ["2,y,z", "3", "q,w"]


def test_sales_of_one_file_are_generated_in_parallel(spark, monkeypatch):
    plans = []

    def written(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        export_csv(df, path)

    monkeypatch.setattr(checks_io, "export_csv", written)
    checks_io.bulk_load_one_file_check(spark, "/root/testdata/sf0.001")
    assert len(plans) == 1 and "Coalesce" not in plans[0] and "Exchange SinglePartition" in plans[0]


def _file_rows(spark, path, schema):
    """The rows of each file, in the order of the file names."""
    from pathlib import Path

    return [[tuple(r) for r in read_delimited(spark, str(f), schema, sep=",").coalesce(1).collect()]
            for f in sorted(Path(path).glob("part-*.csv"))]


def test_files_of_exactly_n_rows_keep_the_order(spark, tmp_dir):
    from starload.sinks.files import export_exact

    rows = spark.range(0, 1003, 1, 7).selectExpr("id AS a", "concat('t ', id % 5) AS b")
    files = export_exact(rows, f"{tmp_dir}/plain", 100)
    got = _file_rows(spark, f"{tmp_dir}/plain", rows.schema)
    assert files == 11 and [len(f) for f in got] == [100] * 10 + [3]
    assert [r[0] for f in got for r in f] == list(range(1003))
    # by other columns, with ties
    export_exact(rows.repartition(5), f"{tmp_dir}/sorted", 250, ["b"])
    got = _file_rows(spark, f"{tmp_dir}/sorted", rows.schema)
    assert [len(f) for f in got] == [250] * 4 + [3]
    assert [r for f in got for r in f] == sorted(((k, f"t {k % 5}") for k in range(1003)), key=lambda r: (r[1], r[0]))
    # no rows, one row a file, and a clashing column name
    assert export_exact(rows.limit(0), f"{tmp_dir}/none", 5) == 1
    assert _file_rows(spark, f"{tmp_dir}/none", rows.schema) == [[]]
    few = rows.limit(3).withColumnRenamed("a", "__row").repartition(2)
    assert export_exact(few, f"{tmp_dir}/one", 1) == 3
    assert sorted(len(f) for f in _file_rows(spark, f"{tmp_dir}/one", few.schema)) == [1, 1, 1]
    with pytest.raises(ValueError):
        export_exact(rows, f"{tmp_dir}/zero", 0)


@pytest.fixture()
def small_blocks(spark):
    """Files are cut into blocks of some 1,500 bytes."""
    for k, v in (("maxPartitionBytes", "1500"), ("openCostInBytes", "0")):
        spark.conf.set(f"spark.sql.files.{k}", v)
    yield
    for k in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{k}")


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_line_ends_inside_quotes_are_read_by_many_tasks(spark, tmp_dir, small_blocks, line_end):
    import csv
    import io
    import os
    import random

    rng = random.Random(8)
    os.makedirs(f"{tmp_dir}/in")
    texts = ["plain", "", 'a "b" c', "two\nlines", "w\r\nx", "\n", '"', '"\n"', "x" * 900, "tab,comma", "é\nü"]
    long, written = "l\n" * 2000, []
    for k in range(3):
        out = io.StringIO()
        w = csv.writer(out, lineterminator=line_end)
        w.writerow(["n", "first\nheader" if k else "t", "u"])
        rows = [(i, rng.choice(texts), rng.choice(texts) if i % 40 else long) for i in range(150 * k, 150 * k + 150)]
        w.writerows(rows)
        written += [(i, t or None, u or None) for i, t, u in rows]  # nothing is written for an empty text
        text = "﻿" * (k == 2) + out.getvalue()
        _write(f"{tmp_dir}/in/{k}.csv", text if k else text.rstrip("\r\n"))
    schema = "n BIGINT, t STRING, u STRING"
    struct = spark.createDataFrame([], schema).schema
    want = spark.read.schema(struct).options(header=True, quote='"', escape='"', multiLine=True, emptyValue="",
                                             nullValue="\u0000").csv(f"{tmp_dir}/in")
    got = read_delimited(spark, f"{tmp_dir}/in", struct, sep=",", multi_line=True)
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(written, key=str)
    if line_end == "\n":  # with CR and LF, Spark's reader of whole files changes values
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert spark.read.text(f"{tmp_dir}/in", lineSep="\n").rdd.getNumPartitions() > 20
    # without a header the first record counts, and its mark goes
    plain = read_delimited(spark, f"{tmp_dir}/in/2.csv", spark.createDataFrame([], "a STRING, b STRING, c STRING").schema,
                           sep=",", header=False, multi_line=True).collect()
    assert len(plain) == 151 and ("n", "first\nheader", "u") in [tuple(r) for r in plain]
    assert read_delimited(spark, [f"{tmp_dir}/in/0.csv", f"{tmp_dir}/in/1.csv"], struct, sep=",", multi_line=True).count() == 300


def test_records_over_several_lines_are_rejected_or_raise(spark, tmp_dir, small_blocks):
    _write(f"{tmp_dir}/x.csv", 'a,b\n1,"x\ny"\n2\nz,"q\n"\n' + '3,"ok\n"\n' * 100)
    schema = spark.createDataFrame([], "a BIGINT, b STRING").schema
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        read_delimited(spark, f"{tmp_dir}/x.csv", schema, sep=",", multi_line=True).collect()
    good, bad = read_delimited_lenient(spark, f"{tmp_dir}/x.csv", schema, sep=",", multi_line=True)
    assert sorted((r.a, r.b) for r in good.collect()) == [(1, "x\ny")] + [(3, "ok\n")] * 100
    assert sorted(r._rejected for r in bad.collect()) == ["2", 'z,"q\n"']
    _write(f"{tmp_dir}/none.csv", "")
    assert read_delimited(spark, f"{tmp_dir}/none.csv", schema, sep=",", multi_line=True).count() == 0


def test_one_file_is_written_from_narrow_columns(spark, tmp_dir):
    from pathlib import Path

    from pyspark.sql import functions as F

    from starload.sinks.files import export_one
    from starload.sources.files import read_delimited

    rows = spark.range(0, 1000, 1, 7).select(
        F.concat(F.lit(' a "'), F.col("id").cast("string")).alias("t"), F.when(F.col("id") % 3 > 0, F.lit("")).alias("e"))
    export_one(rows, f"{tmp_dir}/one")
    assert len(list(Path(tmp_dir, "one").glob("part-*"))) == 1
    back = read_delimited(spark, f"{tmp_dir}/one", rows.schema, sep=",")
    assert back.exceptAll(rows).count() == 0 and back.count() == 1000
    with pytest.raises(Exception, match="line end"):
        export_one(spark.sql("SELECT 'a\n' AS t"), f"{tmp_dir}/bad")
