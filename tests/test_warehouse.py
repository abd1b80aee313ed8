"""End to end: accounting exports -> src -> stage -> mart report, then an
incremental load.  The export rows are made up; they carry the awkward parts
of real exports (BOM, CRLF, NBSP thousands, decimal commas, inner quotes,
whitespace noise, a misspelt counterparty)."""

import datetime as dt
import glob
import itertools
import os

import pytest
from pyspark.sql import functions as F

from starload.plans.warehouse import read_exports, sales_report, stage_initial_load, stage_update

NB = "\u00a0"
DOC = "Реализация (акт, накладная, УПД) 0001"
SALE = "Реализация товаров"
MADE = "Реализация продукции"


def _write(path, lines):
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("\ufeff" + "\r\n".join(lines) + "\r\n")


def _sales_line(d, company, counterparty, contract, qty, item, amount, doc=DOC, op=SALE):
    return "\t".join([d, doc, company, counterparty, contract, "", qty, "grp", "20%", item, amount, op])


def _exports(root, sales_lines, counterparties, nomenclature):
    os.makedirs(root, exist_ok=True)
    _write(f"{root}/sales.txt", ["h\t" * 11 + "h"] + sales_lines)
    _write(f"{root}/counterparties.txt", ["Компания\tИНН\tПолное имя"] + counterparties)
    _write(
        f"{root}/contracts.txt",
        ["Договор\tКонтрагент\tВид\tВалюта\tОрганизация",
         "Договор  1\tПокупатель 1 \tС покупателем\tруб.\tООО Ромашка"],
    )
    _write(f"{root}/nomenclature.txt", ["Справочник номенклатуры", "Наименование\tКод"]
           + [f"{n}\t{i}" for i, n in enumerate(nomenclature)])
    return f"{root}/sales.txt", f"{root}/counterparties.txt", f"{root}/contracts.txt", f"{root}/nomenclature.txt"


FIRST_SALES = [
    _sales_line("12.01.2016 9:00:01", f"ООО{NB}Ромашка ", "Прокупатель 1", "Договор 1",
                f"1{NB}200", "Ассорти", f"540{NB}000,00"),
    _sales_line("13.1.2016 10:5:7", "ООО Ромашка", "Прокупатель 1", "Договор 1",
                "100", " Барбарис", f"20{NB}000,5", op=MADE),
    _sales_line("14.01.2016 11:00:00", "ООО Ромашка", "Прокупатель 1", "Договор 1",
                "5", "Ассорти", f"2{NB}250"),
    _sales_line("15.01.2016 11:00:00", "ООО Ромашка", "Прокупатель 1", "Договор 1",
                "7", "Ассорти", "700", op="Возврат товаров"),
    _sales_line("15.01.2016 12:00:00", "ООО Ромашка", "Прокупатель 1", "Договор 1",
                "9", "Ассорти", "900", doc="Счет на оплату"),
]
FIRST_COUNTERPARTIES = [
    'ООО Ромашка\t0012345\tООО "Ромашка"',
    'Покупатель  1\t0012345\tООО "Покупатель"',
]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda t: tuple((v is not None, v) for v in t))


def test_first_load_and_golden_report(spark, tmp_dir):
    src = read_exports(spark, *_exports(f"{tmp_dir}/l1", FIRST_SALES, FIRST_COUNTERPARTIES,
                                        ["Ассорти", "Барбарис", "Грильяж"]))
    assert src.sales.count() == 3
    cp = {r["company"]: r for r in src.counterparties.collect()}
    assert cp["ООО Ромашка"]["taxpayer_identification_number"] == "0012345"
    assert cp["ООО Ромашка"]["full_name_company"] == 'ООО "Ромашка"'
    assert [tuple(r) for r in src.contracts.collect()] == [
        ("Договор 1", "Покупатель 1", "С покупателем", "руб.", "ООО Ромашка")]
    assert sorted(r[0] for r in src.nomenclature.collect()) == ["Ассорти", "Барбарис", "Грильяж"]

    stage = stage_initial_load(src, "2016-02-01 00:00:00")
    facts = stage.sales.collect()
    assert all(r["counterparty"] is None and r["contract"] is None for r in facts)
    assert all(r["company"] is not None and r["nomenclature"] is not None for r in facts)
    assert _rows(sales_report(stage)) == [
        ("ООО Ромашка", None, None, "Ассорти", 1205, 542250),
        ("ООО Ромашка", None, None, "Барбарис", 100, 20000),
    ]


def test_incremental_load(spark, tmp_dir):
    src1 = read_exports(spark, *_exports(f"{tmp_dir}/l1", FIRST_SALES, FIRST_COUNTERPARTIES,
                                         ["Ассорти", "Барбарис", "Грильяж"]))
    stage = stage_initial_load(src1, "2016-02-01 00:00:00")
    # second export: the misspelt name now exists, tax numbers changed,
    # "Грильяж" is gone, and 12.01 is delivered again
    second_sales = [
        _sales_line("12.01.2016 15:00:00", "ООО Ромашка", "Прокупатель 1", "Договор 1",
                    "1000", "Ассорти", "500000"),
    ]
    counterparties = [
        "ООО Ромашка\t\tООО Ромашка (новое)",
        'Прокупатель 1\t0099\tООО "Прокупатель"',
    ]
    src2 = read_exports(spark, *_exports(f"{tmp_dir}/l2", second_sales, counterparties,
                                         ["Ассорти", "Барбарис"]))
    t2 = "2016-03-01 00:00:00"
    stage2 = stage_update(stage, src2, t2, mode="replace", start="2016-01-12", end="2016-01-12")

    cp = {r["company"]: r for r in stage2.counterparties.collect()}
    assert cp["ООО Ромашка"]["taxpayer_identification_number"] is None  # NULL overwrites
    assert cp["ООО Ромашка"]["full_name_company"] == "ООО Ромашка (новое)"
    assert cp["Покупатель 1"]["is_actual"] is False  # unseen -> expired
    assert cp["Прокупатель 1"]["is_actual"] is True and cp["Прокупатель 1"]["id"] == 3
    nm = {r["nomenclature"]: r["is_actual"] for r in stage2.nomenclature.collect()}
    assert nm == {"Ассорти": True, "Барбарис": True, "Грильяж": False}

    sales = stage2.sales.orderBy("id").collect()
    assert [r["is_actual"] for r in sales] == [False, True, True, True]
    assert sales[3]["counterparty"] == 3 and sales[3]["dt"] == dt.datetime(2016, 1, 12, 15, 0)
    report = _rows(sales_report(stage2))
    assert report == [
        ("ООО Ромашка", None, None, "Ассорти", 5, 2250),
        ("ООО Ромашка", None, None, "Барбарис", 100, 20000),
        ("ООО Ромашка", "Прокупатель 1", None, "Ассорти", 1000, 500000),
    ]


def test_warehouse_job_matches_pure_functions(spark, tmp_dir):
    """The file-backed job (snapshot dimensions, month-partitioned facts
    changed in place) gives the same stage and report as the pure functions."""
    from starload.plans.warehouse import WarehouseJob

    paths1 = _exports(f"{tmp_dir}/l1", FIRST_SALES, FIRST_COUNTERPARTIES,
                      ["Ассорти", "Барбарис", "Грильяж"])
    second_sales = [
        _sales_line("12.01.2016 15:00:00", "ООО Ромашка", "Прокупатель 1", "Договор 1",
                    "1000", "Ассорти", "500000"),
        _sales_line("03.03.2016 15:00:00", "ООО Ромашка", "Прокупатель 1", "Договор 1",
                    "1", "Барбарис", "10"),
    ]
    counterparties = ["ООО Ромашка\t\tООО Ромашка (новое)",
                      'Прокупатель 1\t0099\tООО "Прокупатель"']
    paths2 = _exports(f"{tmp_dir}/l2", second_sales, counterparties, ["Ассорти", "Барбарис"])
    t1, t2 = "2016-02-01 00:00:00", "2016-03-01 00:00:00"

    pure1 = stage_initial_load(read_exports(spark, *paths1), t1)
    pure2 = stage_update(pure1, read_exports(spark, *paths2), t2, mode="replace",
                         start="2016-01-12", end="2016-01-12")

    job = WarehouseJob(spark, f"{tmp_dir}/wh")
    job.initial_load(read_exports(spark, *paths1), t1)
    got = job.update(read_exports(spark, *paths2), t2, mode="replace",
                     start="2016-01-12", end="2016-01-12")

    for name in ("counterparties", "contracts", "nomenclature", "sales"):
        assert _rows(getattr(got, name)) == _rows(getattr(pure2, name)), name
    assert _rows(job.report()) == _rows(sales_report(pure2))


def test_resolve_facts_nulls_unknowns_and_fan_out(spark):
    from starload.plans.warehouse import resolve_facts

    sales = spark.createDataFrame(
        [(dt.datetime(2016, 1, 1), "A", "B", "K", "n1", 1, 10),
         (dt.datetime(2016, 1, 2), "A", None, "K", "n1", 2, 20),
         (dt.datetime(2016, 1, 3), "A", "B", "K", "n2", 3, 30),
         (dt.datetime(2016, 1, 4), "Z", "B", "K", "n1", 4, 40)],
        "dt timestamp_ntz, company string, counterparty string, contract string, "
        "nomenclature string, quantity int, amount int")
    cp = spark.createDataFrame([(1, "A"), (2, "B")], "id long, company string")
    ct = spark.createDataFrame([(5, "K", "B", "A")], "id long, contract string, counterparty string, company string")
    # "n2" appears twice in the dimension: its fact fans out, as a SQL join does
    nm = spark.createDataFrame([(7, "n1"), (8, "n2"), (9, "n2")], "id long, nomenclature string")
    got = sorted(
        (r["quantity"], r["company"], r["counterparty"], r["contract"], r["nomenclature"])
        for r in resolve_facts(sales, cp, ct, nm).collect())
    assert got == [(1, 1, 2, 5, 7), (2, 1, None, None, 7), (3, 1, 2, 5, 8), (3, 1, 2, 5, 9),
                   (4, None, 2, None, 7)]


def _job(spark, tmp_dir, name="wh"):
    from starload.plans.warehouse import WarehouseJob

    return WarehouseJob(spark, f"{tmp_dir}/{name}")


def _first(spark, tmp_dir):
    return read_exports(spark, *_exports(f"{tmp_dir}/l1", FIRST_SALES, FIRST_COUNTERPARTIES,
                                         ["Ассорти", "Барбарис", "Грильяж"]))


def _march(spark, tmp_dir):
    line = _sales_line("03.03.2016 15:00:00", "ООО Ромашка", "Прокупатель 1", "Договор 1", "1", "Барбарис", "10")
    return read_exports(spark, *_exports(f"{tmp_dir}/l2", [line], FIRST_COUNTERPARTIES, ["Ассорти", "Барбарис"]))


def test_warehouse_job_rejects_a_load_timestamp_that_does_not_increase(spark, tmp_dir):
    job = _job(spark, tmp_dir)
    src = _first(spark, tmp_dir)
    job.initial_load(src, "2016-02-01 00:00:00")
    with pytest.raises(ValueError):
        job.update(src, "2016-02-01 00:00:00")
    job.update(_march(spark, tmp_dir), "2016-02-02 00:00:00")
    # the job publishes the report as a named view
    assert _rows(spark.table("mart_sales_report")) == _rows(job.report())


def test_append_adds_folders_and_replace_rewrites_overlapping_ones(spark, tmp_dir):
    job = _job(spark, tmp_dir)
    job.initial_load(_first(spark, tmp_dir), "2016-02-01 00:00:00")
    first = set(job.loads.latest()["facts"])
    job.update(_march(spark, tmp_dir), "2016-03-01 00:00:00")
    second = set(job.loads.latest()["facts"])
    assert first < second and len(second) == len(first) + 1
    job.update(_march(spark, tmp_dir), "2016-04-01 00:00:00", mode="replace", start="2016-03-01", end="2016-03-05")
    third = set(job.loads.latest()["facts"])
    assert first < third and not (second - first) & third
    facts = job.stage().sales.collect()
    assert sorted(r["id"] for r in facts) == [1, 2, 3, 4, 5]
    assert [r["is_actual"] for r in sorted(facts, key=lambda r: r["id"])] == [True, True, True, False, True]


@pytest.mark.parametrize("step", ["land_exports", "check_landing", "update_dimensions", "flag_range", "publish"])
def test_a_failed_load_is_not_seen_and_can_be_repeated(spark, tmp_dir, monkeypatch, step):
    from starload.plans import warehouse
    from starload.sinks.tables import Entries

    job = _job(spark, tmp_dir)
    job.initial_load(_first(spark, tmp_dir), "2016-02-01 00:00:00")
    before = {n: _rows(getattr(job.stage(), n)) for n in ("sales", "nomenclature", "counterparties")}

    def fail(*_, **__):
        raise RuntimeError("lost")

    how = {"mode": "replace", "start": "2016-01-12", "end": "2016-01-12"}
    with monkeypatch.context() as m:
        m.setattr(Entries if step == "publish" else warehouse, step, fail)
        with pytest.raises(RuntimeError):
            job.update(_march(spark, tmp_dir), "2016-03-01 00:00:00", **how)
    assert {n: _rows(getattr(job.stage(), n)) for n in before} == before
    after = job.update(_march(spark, tmp_dir), "2016-03-01 00:00:00", **how)
    assert sorted(r["id"] for r in after.sales.collect()) == [1, 2, 3, 4]


@pytest.mark.parametrize("change", [
    {"sales": {"dt": None}}, {"sales": {"amount": None}}, {"contracts": {"contract": "x" * 51}},
    {"counterparties": {"full_name_company": None}}, {"nomenclature": {"nomenclature": "y" * 251}},
])
def test_gates_refuse_missing_and_over_long_values(spark, tmp_dir, change):
    from dataclasses import replace

    from starload.operators.quality import ConstraintViolation

    src = _first(spark, tmp_dir)
    (table, values), = change.items()
    frame = getattr(src, table)
    for column, value in values.items():
        frame = frame.withColumn(column, F.lit(value).cast(frame.schema[column].dataType))
    job = _job(spark, tmp_dir)
    with pytest.raises(ConstraintViolation):
        job.initial_load(replace(src, **{table: frame}), "2016-02-01 00:00:00")
    assert job.loads.latest() is None


def test_the_report_follows_the_loads_and_reads_no_fact(spark, tmp_dir, monkeypatch):
    from starload.sinks.tables import PeriodFolders

    job, read, seen = _job(spark, tmp_dir), PeriodFolders.read, []
    monkeypatch.setattr(PeriodFolders, "read", lambda self, folders, schema: seen.append(list(folders)) or read(
        self, folders, schema))

    def same():
        assert _rows(job.report()) == _rows(sales_report(job.stage()))
        assert job.report().count() and not any("/stage/sales/" in f for f in job.report().inputFiles())

    job.initial_load(_first(spark, tmp_dir), "2016-02-01 00:00:00")
    same()
    old = job.loads.latest()["facts"]
    seen.clear()
    job.update(_march(spark, tmp_dir), "2016-03-01 00:00:00")
    now = job.loads.latest()["facts"]
    # the first frame is the current stage, which an append does not scan
    scanned = [f for f in seen if f and "/stage/sales/" in f[0]]
    assert scanned[0] == old and scanned[1] == [f for f in now if f not in old]
    same()
    job.update(_march(spark, tmp_dir), "2016-04-01 00:00:00", mode="replace", start="2016-01-13", end="2016-03-02")
    same()
    # nothing actual is left of the first month
    job.update(_march(spark, tmp_dir), "2016-05-01 00:00:00", mode="replace", start="2016-01-01", end="2016-01-31")
    same()
    assert {r["company"] for r in job.report().collect()} == {"ООО Ромашка"}


_SALES = ("dt timestamp_ntz, company string, counterparty string, contract string, nomenclature string, "
          "quantity int, amount int")


def _many_sales(spark, n=3000):
    def pick(column, k):
        return F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit(column), (F.col("id") % k).cast("string")))

    rows = spark.range(0, n, 1, 3).select(
        F.lit(dt.datetime(2016, 1, 1)).cast("timestamp_ntz").alias("dt"),
        pick("c", 7).alias("company"),
        F.when(F.col("id") % 10 == 1, None).otherwise(pick("p", 11)).alias("counterparty"),
        F.when(F.col("id") % 13 == 1, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 3).cast("string"))).alias("contract"),
        pick("n", 5).alias("nomenclature"),
        F.col("id").cast("int").alias("quantity"), F.lit(1).alias("amount"))
    names = ["hot", *[f"{x}{i}" for x in "cp" for i in range(9)]]
    cp = spark.createDataFrame([(i, x) for i, x in enumerate(names)] + [(900, "hot"), (901, None)], "id long, company string")
    ct = spark.createDataFrame([(i, f"k{i % 2}", b, a) for i, (a, b) in enumerate((a, b) for a in names for b in names)],
                               "id long, contract string, counterparty string, company string")
    nm = spark.createDataFrame([(1, "hot"), (2, "n1"), (3, "n1"), (4, "n3")], "id long, nomenclature string")
    return rows, cp, ct, nm


def test_shared_lookups_give_the_same_facts(spark):
    from starload.plans.warehouse import hot_values, resolve_facts, resolve_facts_shared

    tables = _many_sales(spark)
    assert hot_values(tables[0], {"company": F.col("company")})["company"].count("hot") == 1
    assert _rows(resolve_facts_shared(*tables)) == _rows(resolve_facts(*tables))
    empty = tables[0].limit(0)
    assert resolve_facts_shared(empty, *tables[1:]).count() == 0


def test_large_dimensions_cost_the_facts_one_exchange(spark, tmp_dir):
    from starload.plans.warehouse import may_broadcast, resolve_facts, resolve_facts_shared

    tables = []
    for k, table in enumerate(_many_sales(spark)):
        table.write.parquet(f"{tmp_dir}/{k}")
        tables.append(spark.read.parquet(f"{tmp_dir}/{k}"))
    assert may_broadcast(*tables[1:])

    def exchanges(df):
        """Exchanges that carry the facts' measures."""
        text = df._jdf.queryExecution().executedPlan().toString()
        lines = text.splitlines()
        found = 0
        for i, line in enumerate(lines):
            if "Exchange hashpartitioning" in line:
                depth = len(line) - len(line.lstrip(" :+-*|"))
                below = next(x for x in lines[i + 1:])
                found += "amount" in below and len(below) - len(below.lstrip(" :+-*|")) > depth
        return found

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not may_broadcast(*tables[1:])
        shared, chained = resolve_facts_shared(*tables), resolve_facts(*tables)
        assert (exchanges(shared), exchanges(chained)) == (1, 4)
        assert _rows(shared) == _rows(chained)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_combinations_stay_where_they_became_distinct(spark, tmp_dir):
    """Contracts come to the combinations without an exchange of these; items go to all tasks."""
    from starload.plans.warehouse import resolve_facts_shared

    tables = []
    for k, table in enumerate(_many_sales(spark)):
        table.write.parquet(f"{tmp_dir}/{k}")
        tables.append(spark.read.parquet(f"{tmp_dir}/{k}"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = resolve_facts_shared(*tables)._jdf.queryExecution().executedPlan().toString()
        # the combinations, their contracts, the facts; and for company and counterparty
        # both sides, and the way back
        assert plan.count("Exchange hashpartitioning") == 3 + 2 * 2 + 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sums_without_a_contract_are_not_exchanged_for_its_name(spark, tmp_dir):
    from starload.plans.warehouse import SUMS_SCHEMA, report_of_sums

    rows = [(1, 1, 1 if i % 3 == 0 else None if i % 3 == 1 else 7, 1, 1, i, 2) for i in range(30)]
    spark.createDataFrame(rows, SUMS_SCHEMA).write.parquet(f"{tmp_dir}/sums")
    cp = spark.createDataFrame([(1, "a")], "id long, company string")
    ct = spark.createDataFrame([(1, "k")], "id long, contract string")
    nm = spark.createDataFrame([(1, "n")], "id long, nomenclature string")
    report = report_of_sums(spark.read.parquet(f"{tmp_dir}/sums"), cp, ct, nm)
    # an id without its row has no name either and falls to the same line
    assert _rows(report) == [("a", "a", None, "n", sum(i for i in range(30) if i % 3), 40),
                             ("a", "a", "k", "n", sum(range(0, 30, 3)), 20)]
    assert "isnotnull(contract#" in report._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("few", [0, 100_000])
def test_missing_and_empty_names_differ_in_shared_lookups(spark, monkeypatch, few):
    from starload.plans import warehouse

    monkeypatch.setattr(warehouse, "FEW_ITEMS", few)
    names = [None, "", "a", "b"]
    day = dt.datetime(2016, 1, 1)
    sales = spark.createDataFrame(
        [(day, a, b, c, n, i, 1) for i, (a, b, c, n) in enumerate(itertools.product(names, repeat=4))], _SALES)
    cp = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (4, "a")], "id long, company string")
    ct = spark.createDataFrame(
        [(i, c, b, a) for i, (c, b, a) in enumerate(itertools.product(names[:3], repeat=3))] + [(90, "a", "a", "a")],
        "id long, contract string, counterparty string, company string")
    nm = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (4, "a")], "id long, nomenclature string")
    want = _rows(warehouse.resolve_facts(sales, cp, ct, nm))
    assert _rows(warehouse.resolve_facts_shared(sales, cp, ct, nm)) == want
    hot = sales.union(sales.where("company = 'a' AND counterparty = 'a' AND contract = 'a'").crossJoin(
        spark.range(50)).drop("id"))
    assert _rows(warehouse.resolve_facts_shared(hot, cp, ct, nm)) == _rows(warehouse.resolve_facts(hot, cp, ct, nm))


def test_a_job_can_compress_its_csv_files(spark, tmp_dir):
    from starload.plans.warehouse import WarehouseJob
    from starload.sources.files import read_glob

    src = read_exports(spark, *_exports(f"{tmp_dir}/l1", FIRST_SALES, FIRST_COUNTERPARTIES,
                                        ["Ассорти", "Барбарис", "Грильяж"]))
    for name, compression, ending in (("plain", None, ".csv"), ("packed", "gzip", ".csv.gz")):
        job = WarehouseJob(spark, f"{tmp_dir}/{name}", csv_compression=compression)
        job.initial_load(src, "2016-02-01 00:00:00")
        found = glob.glob(f"{tmp_dir}/{name}/csv/*/sales/part-*")
        assert found and all(f.endswith(ending) for f in found)
        back = read_glob(spark, f"{tmp_dir}/{name}/csv/*/sales/part-*", src.sales.schema, sep=",")
        assert _rows(back) == _rows(src.sales)


def test_an_upsert_into_buckets_exchanges_the_source_alone(spark, tmp_dir):
    from starload.operators.upsert import expire_unseen, initial_load, upsert
    from starload.sinks.tables import read_bucketed, write_bucketed

    names = spark.range(500).selectExpr("concat('n', id) AS company", "string(id) AS tax", "id % 7 AS k")
    first = initial_load(names, ["company", "tax", "k"], "2016-02-01")
    target = write_bucketed(first, f"{tmp_dir}/v1", ["company", "k"], 4)
    source = spark.range(250, 600).selectExpr("concat('n', id) AS company", "string(2 * id) AS tax", "id % 7 AS k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = expire_unseen(upsert(target, source, ["company", "k"], "2016-03-01", update_cols=["tax"]), "2016-03-01")
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SelectedBucketsCount: 4 out of 4" in plan and plan.count("Exchange hashpartitioning") == 1
        want = _rows(expire_unseen(upsert(first, source, ["company", "k"], "2016-03-01", update_cols=["tax"]), "2016-03-01"))
        assert _rows(merged) == want
        # written without another exchange, it is a table of the same buckets
        write_bucketed(merged, f"{tmp_dir}/v2", ["company", "k"], 4, spread=False)
        spark.sql(f"DROP TABLE {[t.name for t in spark.catalog.listTables() if t.name.startswith('bucketed_')][0]}")
        for path in ("v1", "v2"):  # as a session that did not write them reads them
            again = read_bucketed(spark, f"{tmp_dir}/{path}", ["company", "k"], 4)
            joined = again.join(source, ["company", "k"])
            assert joined._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        assert _rows(read_bucketed(spark, f"{tmp_dir}/v2", ["company", "k"], 4)) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_loads_with_buckets_and_retired_folders(spark, tmp_dir):
    from pathlib import Path

    from starload.plans.warehouse import WarehouseJob

    plain, bucketed = _job(spark, tmp_dir, "plain"), WarehouseJob(spark, f"{tmp_dir}/buckets", dimension_buckets=3)
    loads = [(_first(spark, tmp_dir), {}), (_march(spark, tmp_dir), {}),
             (_march(spark, tmp_dir), {"mode": "replace", "start": "2016-01-12", "end": "2016-01-13"}),
             (_march(spark, tmp_dir), {})]
    for job in (plain, bucketed):
        for k, (src, how) in enumerate(loads):
            at = f"2016-0{k + 2}-01 00:00:00"
            job.update(src, at, **how) if k else job.initial_load(src, at)
        (Path(job.root) / "stage/sales/lost").mkdir()  # of a load that failed
    for name in ("counterparties", "contracts", "nomenclature", "sales"):
        assert _rows(getattr(bucketed.stage(), name)) == _rows(getattr(plain.stage(), name)), name
    for job in (plain, bucketed):
        before = {n: _rows(getattr(job.stage(), n)) for n in ("sales", "counterparties", "contracts")}
        report, size = _rows(job.report()), sum(1 for _ in Path(job.root).rglob("*.parquet"))
        gone = job.retire(keep=1)
        assert any(f.endswith("/lost") for f in gone) and sum(1 for _ in Path(job.root).rglob("*.parquet")) < size
        assert {n: _rows(getattr(job.stage(), n)) for n in before} == before and _rows(job.report()) == report
        assert job.retire(keep=1) == []
        job.update(_march(spark, tmp_dir), "2016-08-01 00:00:00")


def test_a_load_keeps_bad_lines_apart(spark, tmp_dir):
    good = _sales_line("12.01.2016 9:00:01", "ООО Ромашка", "Покупатель 1", "Договор 1", "1", "Ассорти", "5")
    bad = [good + "\tmore", good.replace("9:00:01", "25:00"), good.replace("\t5\t", "\tfive\t"), "kurz",
           good.replace("\t1\t", "\t99999999999\t")]
    other = good.replace(SALE, "Возврат").replace("\t5\t", "\tfive\t")  # not taken, so not looked at
    paths = _exports(f"{tmp_dir}/x", [good, *bad, other, good], FIRST_COUNTERPARTIES + ["nur ein Feld"], ["Ассорти"])
    with pytest.raises(Exception):  # noqa: B017
        _job(spark, tmp_dir, "strict").initial_load(read_exports(spark, *paths), "2016-02-01 00:00:00")
    job = _job(spark, tmp_dir)
    assert job.rejects().count() == 0
    job.initial_load(read_exports(spark, *paths, keep_rejects=True), "2016-02-01 00:00:00")
    assert _rows(job.rejects()) == sorted([*(("sales", line) for line in bad), ("counterparties", "nur ein Feld")])
    assert job.stage().sales.count() == 2 and job.stage().counterparties.count() == 2
    job.update(_march(spark, tmp_dir), "2016-03-01 00:00:00")
    assert job.rejects().columns == ["table", "line"] and job.rejects().count() == 0


def test_facts_must_refer_to_dimension_rows(spark, tmp_dir, monkeypatch):
    from starload.operators.quality import ConstraintViolation
    from starload.plans import warehouse

    job = _job(spark, tmp_dir)
    job.initial_load(_first(spark, tmp_dir), "2016-02-01 00:00:00")
    before = _rows(job.report())
    resolve = warehouse.resolve_facts
    monkeypatch.setattr(warehouse, "resolve_facts", lambda *tables: resolve(*tables).withColumn(
        "nomenclature", F.lit(77)))
    with pytest.raises(ConstraintViolation, match="nomenclature"):
        job.update(_march(spark, tmp_dir), "2016-03-01 00:00:00")
    assert _rows(job.report()) == before
    monkeypatch.undo()
    job.update(_march(spark, tmp_dir), "2016-03-01 00:00:00")


def _own_combinations(spark, tmp_dir):
    """Sales of which most have a combination of names of their own, and a hot one; with
    missing and empty names, unknown ones, and names that a dimension has twice."""
    day = dt.datetime(2016, 1, 1)
    rows = [(day, f"c{i % 40}", f"p{i % 41}", f"k{i % 3}", f"n{i % 4}", i, 1) for i in range(1200)]
    rows += [(day, a, b, c, "n1", i, 2) for i, (a, b, c) in enumerate(
        itertools.product([None, "", "c1", "hot"], [None, "", "p1", "hot"], [None, "", "k1"]))]
    rows += [(day, "hot", "hot", "k1", "n2", i, 3) for i in range(200)] + [(day, None, "p2", "k1", "n2", i, 3) for i in range(60)]
    names = ["hot", "", *[f"{x}{i}" for x in "cp" for i in range(1, 30)]]
    tables = [
        spark.createDataFrame(rows, _SALES),
        spark.createDataFrame([(i, x) for i, x in enumerate(names)] + [(900, "hot"), (901, None)], "id long, company string"),
        spark.createDataFrame(
            [(i, f"k{i % 2}", b, a) for i, (a, b) in enumerate((a, b) for a in names for b in names)]
            + [(99_000, "k1", None, "hot"), (99_001, None, "hot", "hot"), (99_002, "k1", "hot", "hot")],
            "id long, contract string, counterparty string, company string"),
        spark.createDataFrame([(1, "n0"), (2, "n1"), (3, "n1"), (4, "n2")], "id long, nomenclature string")]
    for k, table in enumerate(tables):
        table.write.parquet(f"{tmp_dir}/{k}")
    return [spark.read.parquet(f"{tmp_dir}/{k}") for k in range(4)]


def test_facts_of_their_own_combinations_are_looked_up_unsorted(spark, tmp_dir):
    from starload.plans.warehouse import hot_values, resolve_facts, resolve_facts_shared

    tables = _own_combinations(spark, tmp_dir)
    seen = {"company": 0}
    hot = hot_values(tables[0], {"company": F.col("company")}, seen)["company"]
    assert "hot" in hot and None in hot and seen["n"] == tables[0].count() and 38 <= seen["company"] <= 48
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shared = resolve_facts_shared(*tables)
        plan = shared._jdf.queryExecution().executedPlan().toString()
        # both sides of three lookups, and neither the combinations nor a sort
        assert plan.count("Exchange hashpartitioning") == 6 and "Sort" not in plan
        assert _rows(shared) == _rows(resolve_facts(*tables))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_upsert_sorts_no_target(spark, tmp_dir, monkeypatch):
    from starload.operators import joins
    from starload.operators.upsert import initial_load, upsert
    from starload.sinks.tables import write_bucketed

    names = spark.range(500).selectExpr("concat('n', id) AS company", "string(id) AS tax")
    first = initial_load(names, ["company", "tax"], "2016-02-01")
    target = write_bucketed(first, f"{tmp_dir}/v1", ["company"], 4)
    source = spark.range(250, 600).selectExpr("concat('n', id) AS company", "string(2 * id) AS tax").union(
        spark.createDataFrame([("new", "1"), ("new", "2"), (None, "3"), (None, "4")], "company string, tax string"))

    def merged(rows):
        monkeypatch.setattr(joins, "HASH_ROWS", rows)
        found = upsert(target, source, ["company"], "2016-03-01", update_cols=["tax"], tasks=4)
        return found._jdf.queryExecution().executedPlan().toString(), _rows(found)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held, sorted_ = merged(1000), merged(10)
        assert "ShuffledHashJoin" in held[0] and "SortMergeJoin" not in held[0]
        # more rows than a task may hold: the planner's choice, as before
        assert "ShuffledHashJoin" not in sorted_[0] and "SortMergeJoin" in sorted_[0]
        assert held[1] == sorted_[1] and len(held[1]) == 604
        twice = source.union(spark.createDataFrame([("n300", "x")], "company string, tax string"))
        with pytest.raises(ValueError, match="several source rows"):
            upsert(target, twice, ["company"], "2016-03-01", tasks=4)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_facts_are_not_resolved_in_the_tasks_of_the_buckets(spark, tmp_dir, monkeypatch):
    from starload.plans.warehouse import WarehouseJob

    job, new_facts, plans = WarehouseJob(spark, f"{tmp_dir}/wh", dimension_buckets=3), WarehouseJob._new_facts, []

    def seen(self, landed, *rest):
        plans.extend(d._jdf.queryExecution().executedPlan().toString() for d in rest[:3])
        return new_facts(self, landed, *rest)

    monkeypatch.setattr(WarehouseJob, "_new_facts", seen)
    job.initial_load(_first(spark, tmp_dir), "2016-02-01 00:00:00")
    job.update(_march(spark, tmp_dir), "2016-03-01 00:00:00")
    assert len(plans) == 6 and not any("Bucketed: true" in p for p in plans)


def test_only_ids_outside_the_run_of_a_dimension_are_looked_for(spark, monkeypatch):
    from starload.operators.quality import ConstraintViolation
    from starload.plans import warehouse

    asked, orphans = [], warehouse.orphans
    monkeypatch.setattr(warehouse, "orphans", lambda ids, *rest: asked.append(ids.count()) or orphans(ids, *rest))

    def ids(*values):
        return spark.createDataFrame([(v,) for v in values], "id long")

    def sums(*rows):
        return spark.createDataFrame([(*r, 1, 1, 1) for r in rows], warehouse.SUMS_SCHEMA)

    rows = [(1, 2, None, 1), (2, 3, 4, 1), (3, None, 6, 1)]
    warehouse.check_references(sums(*rows), ids(1, 2, 3), ids(4, 6), ids(1))
    assert asked == [0, 0, 3, 0]  # contract 5 is not there, so all of them are looked for
    warehouse.check_references(sums((None, None, None, None)), ids(1), ids(), ids(1, 1))
    for k, bad in enumerate([(4, 1, 4, 1), (1, 0, 4, 1), (1, 1, 5, 1), (1, 1, 4, 2)]):
        with pytest.raises(ConstraintViolation, match=warehouse._IDS[k]):
            warehouse.check_references(sums(*rows, bad), ids(1, 2, 3), ids(4, 6), ids(1))
