"""The warehouse flow (landing -> stage -> mart) on data derived from the
driver tables.

Landing exports derived from TPC-H: counterparties are customer names outside
the BUILDING segment plus supplier names; contracts are the urgent and high
priority (priority, supplier, customer) triples; nomenclature is the set of
part brands; sales are line items with the names of their supplier, customer,
order priority and part brand.  Facts of BUILDING customers therefore resolve
to a NULL counterparty and contract, as the misspelt names do in the
accounting sample.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators.joins import left_lookup
from starload.operators.setops import top_n, union_all
from starload.functions.sql_functions import create_report_view
from starload.plans import tpch
from starload.plans.warehouse import (
    Exports,
    WarehouseJob,
    land_exports,
    resolve_facts,
    resolve_facts_shared,
    sales_report,
)
from starload.session import read_table, scratch_path, stored
from starload.sources.catalog import run_sql

LOAD_TS = "2024-01-01 00:00:00"


def counterparty_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    supplier = read_table(spark, sf_dir, "supplier")
    return union_all(
        [
            customer.where(F.col("c_mktsegment") != "BUILDING").select(
                F.col("c_name").alias("company"),
                F.col("c_custkey").cast("string").alias("taxpayer_identification_number"),
                F.concat(F.lit("LLC "), F.col("c_name")).alias("full_name_company"),
            ),
            supplier.select(
                F.col("s_name").alias("company"),
                F.lit(None).cast("string").alias("taxpayer_identification_number"),
                F.concat(F.lit("JSC "), F.col("s_name")).alias("full_name_company"),
            ),
        ]
    )


def src_exports(spark: SparkSession, sf_dir: str) -> Exports:
    customer = read_table(spark, sf_dir, "customer")
    supplier = read_table(spark, sf_dir, "supplier")
    orders = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")

    counterparties = counterparty_export(spark, sf_dir)
    lines = lineitem.select(
        "l_orderkey", "l_suppkey", "l_partkey", "l_shipdate",
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_extendedprice")).cast("int").alias("amount"),
    )
    # the short names come first: an exchange for a later lookup carries them
    lines = left_lookup(lines, part, {"l_partkey": "p_partkey"}, {"p_brand": "nomenclature"})
    lines = left_lookup(
        lines,
        left_lookup(orders.select("o_orderkey", "o_custkey", "o_orderpriority"), customer,
                    {"o_custkey": "c_custkey"}, {"c_name": "c_name"}),
        {"l_orderkey": "o_orderkey"},
        {"c_name": "counterparty", "o_orderpriority": "contract"},
    )
    lines = left_lookup(lines, supplier, {"l_suppkey": "s_suppkey"}, {"s_name": "company"})
    sales = lines.select(
        F.col("l_shipdate").alias("dt"),
        "company",
        "counterparty",
        "contract",
        "nomenclature",
        "quantity",
        "amount",
    )
    # the export's sales and its contract list come from one join result
    sales = stored(sales, "export-sales")
    contracts = (
        sales.where(F.col("contract").isin("1-URGENT", "2-HIGH"))
        .select("contract", "counterparty", "company")
        .distinct()
        .select(
            "contract",
            "counterparty",
            F.lit("sale").alias("type_contract"),
            F.lit("RUB").alias("currency"),
            "company",
        )
    )
    nomenclature = part.select(F.col("p_brand").alias("nomenclature")).distinct()
    return Exports(sales, counterparties, contracts, nomenclature)


_SRC_SQL = """
WITH counterparties AS (
  SELECT c_name AS company, CAST(c_custkey AS VARCHAR) AS taxpayer_identification_number,
         'LLC ' || c_name AS full_name_company
  FROM customer WHERE c_mktsegment <> 'BUILDING'
  UNION ALL
  SELECT s_name, NULL, 'JSC ' || s_name FROM supplier),
sales AS (
  SELECT l.l_shipdate AS dt, s.s_name AS company, c.c_name AS counterparty,
         o.o_orderpriority AS contract, p.p_brand AS nomenclature,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         CAST(ROUND(l.l_extendedprice) AS INTEGER) AS amount
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey),
contracts AS (
  SELECT DISTINCT contract, counterparty, company FROM sales
  WHERE contract IN ('1-URGENT', '2-HIGH')),
d_cp AS (
  SELECT CAST(row_number() OVER (ORDER BY company, taxpayer_identification_number NULLS FIRST,
                                 full_name_company) AS BIGINT) AS id, *
  FROM counterparties),
d_ct AS (
  SELECT CAST(row_number() OVER (ORDER BY contract, counterparty, company) AS BIGINT) AS id, *
  FROM contracts),
d_nm AS (
  SELECT CAST(row_number() OVER (ORDER BY nomenclature) AS BIGINT) AS id, nomenclature
  FROM (SELECT DISTINCT p_brand AS nomenclature FROM part)),
facts AS (
  SELECT s.dt, CAST(c1.id AS INTEGER) AS company, CAST(c2.id AS INTEGER) AS counterparty,
         CAST(c3.id AS INTEGER) AS contract, CAST(n.id AS INTEGER) AS nomenclature,
         s.quantity, s.amount
  FROM sales s
  LEFT JOIN d_cp c1 ON s.company = c1.company
  LEFT JOIN d_cp c2 ON s.counterparty = c2.company
  LEFT JOIN d_ct c3 ON s.contract = c3.contract AND s.company = c3.company
                   AND s.counterparty = c3.counterparty
  LEFT JOIN d_nm n ON s.nomenclature = n.nomenclature)
"""


def _dims(spark, sf_dir):
    from starload.operators.upsert import initial_load

    src = land_exports(src_exports(spark, sf_dir), scratch_path(spark, "src"))
    cp = initial_load(src.counterparties,
                      ["company", "taxpayer_identification_number", "full_name_company"], LOAD_TS)
    ct = initial_load(src.contracts, ["contract", "counterparty", "company"], LOAD_TS)
    nm = initial_load(src.nomenclature, ["nomenclature"], LOAD_TS)
    return src, cp, ct, nm


def resolve_facts_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, cp, ct, nm = _dims(spark, sf_dir)
    return resolve_facts(src.sales, cp, ct, nm)


RESOLVE_FACTS_SQL = _SRC_SQL + "SELECT * FROM facts"


def _hot_name(customer: DataFrame) -> str:
    return customer.where("c_mktsegment <> 'BUILDING'").agg(F.min("c_name")).first()[0]


def resolve_facts_hot_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One customer's name on every third sale, resolved as with dimensions that
    are too large for a broadcast."""
    src, cp, ct, nm = _dims(spark, sf_dir)
    name = _hot_name(read_table(spark, sf_dir, "customer"))
    hot = src.sales.withColumn(
        "counterparty", F.when(F.col("quantity") % 3 == 0, F.lit(name)).otherwise(F.col("counterparty")))
    return resolve_facts_shared(hot, cp, ct, nm)


RESOLVE_FACTS_HOT_SQL = _SRC_SQL.replace("FROM sales s\n", "FROM hot_sales s\n").replace("d_cp AS (", """hot_sales AS (
  SELECT * REPLACE (CASE WHEN quantity % 3 = 0 THEN (
      SELECT min(c_name) FROM customer WHERE c_mktsegment <> 'BUILDING') ELSE counterparty END AS counterparty)
  FROM sales),
d_cp AS (""", 1) + "SELECT * FROM facts"


def initial_load_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counterparty dimension after its first load (ids + audit)."""
    from starload.operators.upsert import initial_load

    columns = ["company", "taxpayer_identification_number", "full_name_company"]
    return initial_load(counterparty_export(spark, sf_dir), columns, LOAD_TS)


INITIAL_LOAD_SQL = _SRC_SQL + f"""
SELECT id, company, taxpayer_identification_number, full_name_company,
       TIMESTAMP '{LOAD_TS}' AS dt_create, TIMESTAMP '{LOAD_TS}' AS dt_update,
       true AS is_actual
FROM d_cp
"""


def stage_report_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initial stage load, then the mart report over it."""
    job = WarehouseJob(spark, scratch_path(spark, "warehouse"), csv_compression="gzip")
    job.initial_load(src_exports(spark, sf_dir), LOAD_TS)
    return job.report()


STAGE_REPORT_SQL = _SRC_SQL + """
SELECT c1.company AS company, c2.company AS counterparty, c3.contract AS contract,
       n.nomenclature AS nomenclature,
       CAST(sum(f.quantity) AS BIGINT) AS total_quantity,
       CAST(sum(f.amount) AS BIGINT) AS total_amount
FROM facts f
LEFT JOIN d_cp c1 ON f.company = c1.id
LEFT JOIN d_cp c2 ON f.counterparty = c2.id
LEFT JOIN d_ct c3 ON f.contract = c3.id
LEFT JOIN d_nm n ON f.nomenclature = n.id
GROUP BY 1, 2, 3, 4
"""


def union_all_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counterparty_export(spark, sf_dir)


UNION_ALL_SQL = _SRC_SQL + "SELECT * FROM counterparties"


def top_n_report_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest report rows by amount (a top-k report)."""
    report = tpch.sales_report(spark, sf_dir)
    return top_n(report, 10, [F.col("total_amount").desc(), "company", "counterparty",
                              "contract", "nomenclature"])


TOP_N_REPORT_SQL = (
    "SELECT * FROM (" + tpch.SALES_REPORT_SQL + ") r "
    "ORDER BY total_amount DESC, company, counterparty, contract, nomenclature LIMIT 10"
)


def report_view_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    create_report_view(spark, "mart_report", tpch.sales_report(spark, sf_dir))
    return run_sql(spark, "SELECT * FROM mart_report WHERE contract = :c", c="1-URGENT")


REPORT_VIEW_SQL = (
    "SELECT * FROM (" + tpch.SALES_REPORT_SQL + ") r WHERE contract = '1-URGENT'"
)


# ---------------------------------------------------------- incremental load

LOAD_TS_2 = "2024-02-01 00:00:00"
SECOND_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


def second_exports(spark: SparkSession, sf_dir: str, first: Exports) -> Exports:
    """The next export: customers of nation 1 are gone, every other customer
    (BUILDING included) comes with a new tax number and full name; the 1998
    sales are delivered again with doubled quantities; medium-priority
    contracts are added; the part brands are unchanged."""
    customer = read_table(spark, sf_dir, "customer")
    supplier = read_table(spark, sf_dir, "supplier")
    counterparties = union_all(
        [
            customer.where(F.col("c_nationkey") != 1).select(
                F.col("c_name").alias("company"),
                (F.col("c_custkey") * 7).cast("string").alias("taxpayer_identification_number"),
                F.concat(F.lit("LLC "), F.col("c_name"), F.lit(" (2)")).alias("full_name_company"),
            ),
            supplier.select(
                F.col("s_name").alias("company"),
                F.lit(None).cast("string").alias("taxpayer_identification_number"),
                F.concat(F.lit("JSC "), F.col("s_name")).alias("full_name_company"),
            ),
        ]
    )
    sales = first.sales.where(F.year("dt") == 1998).withColumn(
        "quantity", (F.col("quantity") * 2).cast("int")
    )
    contracts = (
        sales.where(F.col("contract").isin(*SECOND_PRIORITIES))
        .select("contract", "counterparty", "company")
        .distinct()
        .select("contract", "counterparty", F.lit("sale").alias("type_contract"),
                F.lit("RUB").alias("currency"), "company")
    )
    return Exports(sales, counterparties, contracts, first.nomenclature)


def _updated_job(spark, sf_dir) -> WarehouseJob:
    """Two loads into dimensions that are stored in buckets of their keys."""
    job = WarehouseJob(spark, scratch_path(spark, "warehouse"), dimension_buckets=8, csv_compression="gzip")
    first = src_exports(spark, sf_dir)
    job.initial_load(first, LOAD_TS)
    second = second_exports(spark, sf_dir, first)
    job.update(second, LOAD_TS_2, mode="replace", start="1998-01-01", end="1998-12-31")
    return job


def _updated_stage(spark, sf_dir):
    return _updated_job(spark, sf_dir).stage()


def stage_update_dims_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counterparty dimension after the incremental load (type-1 + expiry)."""
    return _updated_stage(spark, sf_dir).counterparties


_SECOND_SQL = _SRC_SQL.rstrip() + f""",
cp2src AS (
  SELECT c_name AS company, CAST(c_custkey * 7 AS VARCHAR) AS taxpayer_identification_number,
         'LLC ' || c_name || ' (2)' AS full_name_company
  FROM customer WHERE c_nationkey <> 1
  UNION ALL
  SELECT s_name, NULL, 'JSC ' || s_name FROM supplier),
s2 AS (
  SELECT dt, company, counterparty, contract, nomenclature, quantity * 2 AS quantity, amount
  FROM sales WHERE year(dt) = 1998),
cp_names AS (SELECT company FROM d_cp UNION SELECT company FROM cp2src),
ct_keys AS (
  SELECT contract, counterparty, company FROM d_ct
  UNION
  SELECT contract, counterparty, company FROM s2
  WHERE contract IN ('1-URGENT', '2-HIGH', '3-MEDIUM')),
old_named AS (
  SELECT c1.company, c2.company AS counterparty, c3.contract, n.nomenclature,
         s.quantity, s.amount
  FROM sales s
  LEFT JOIN d_cp c1 ON s.company = c1.company
  LEFT JOIN d_cp c2 ON s.counterparty = c2.company
  LEFT JOIN d_ct c3 ON s.contract = c3.contract AND s.company = c3.company
                   AND s.counterparty = c3.counterparty
  LEFT JOIN d_nm n ON s.nomenclature = n.nomenclature
  WHERE year(s.dt) <> 1998),
new_named AS (
  SELECT c1.company, c2.company AS counterparty, c3.contract, n.nomenclature,
         s.quantity, s.amount
  FROM s2 s
  LEFT JOIN cp_names c1 ON s.company = c1.company
  LEFT JOIN cp_names c2 ON s.counterparty = c2.company
  LEFT JOIN ct_keys c3 ON s.contract = c3.contract AND s.company = c3.company
                      AND s.counterparty = c3.counterparty
  LEFT JOIN d_nm n ON s.nomenclature = n.nomenclature)
"""

STAGE_UPDATE_DIMS_SQL = _SECOND_SQL + f"""
SELECT t.id, t.company,
       CASE WHEN s.company IS NOT NULL THEN s.taxpayer_identification_number
            ELSE t.taxpayer_identification_number END AS taxpayer_identification_number,
       CASE WHEN s.company IS NOT NULL THEN s.full_name_company
            ELSE t.full_name_company END AS full_name_company,
       TIMESTAMP '{LOAD_TS}' AS dt_create,
       CASE WHEN s.company IS NOT NULL THEN TIMESTAMP '{LOAD_TS_2}'
            ELSE TIMESTAMP '{LOAD_TS}' END AS dt_update,
       s.company IS NOT NULL AS is_actual
FROM d_cp t LEFT JOIN cp2src s ON t.company = s.company
UNION ALL
SELECT CAST((SELECT max(id) FROM d_cp) + row_number() OVER (ORDER BY s.company) AS BIGINT),
       s.company, s.taxpayer_identification_number, s.full_name_company,
       TIMESTAMP '{LOAD_TS_2}', TIMESTAMP '{LOAD_TS_2}', true
FROM cp2src s WHERE NOT EXISTS (SELECT 1 FROM d_cp t WHERE t.company = s.company)
"""


def stage_update_report_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mart report after the incremental load with a replaced year."""
    return sales_report(_updated_stage(spark, sf_dir))


def report_of_sums_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report that the job keeps up to date, after the same two loads: from
    the sums beside the fact folders, without a scan of the facts."""
    return _updated_job(spark, sf_dir).report()


STAGE_UPDATE_REPORT_SQL = _SECOND_SQL + """
SELECT company, counterparty, contract, nomenclature,
       CAST(sum(quantity) AS BIGINT) AS total_quantity,
       CAST(sum(amount) AS BIGINT) AS total_amount
FROM (SELECT * FROM old_named UNION ALL SELECT * FROM new_named)
GROUP BY 1, 2, 3, 4
"""


# -------------------------------------------------------------- export files


def cleanse_exports_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items printed as the accounting system prints its sales export
    (tab-separated, CRLF, ``d.M.yyyy H:m:s``, NBSP thousands, decimal comma,
    whitespace noise, non-sales rows mixed in), then read and cleansed (P0)."""
    from starload.functions.text import NBSP
    from starload.plans.warehouse import SALES_EXPORT_SCHEMA, cleanse_sales
    from starload.sources.files import read_delimited

    base = src_exports_with_flags(spark, sf_dir)

    def localised(c):
        text = F.replace(c.cast("string"), F.lit("."), F.lit(","))
        return F.regexp_replace(text, r"(\d)(?=(\d{3})+(,|$))", "$1" + NBSP)

    export = base.select(
        F.date_format("dt", "d.M.yyyy H:m:s").alias("dt"),
        F.when(F.col("l_returnflag") == "R", F.lit("Счет на оплату"))
        .otherwise(F.lit("Реализация (акт, накладная, УПД)"))
        .alias("accounting_document"),
        F.concat(F.lit(NBSP), F.col("company"), F.lit("  ")).alias("company"),
        F.regexp_replace("counterparty", "#", "  #").alias("counterparty"),
        "contract",
        F.lit("").alias("accounting_document_"),
        localised(F.col("quantity")).alias("quantity"),
        F.lit("Товары").alias("nomenclature_group"),
        F.lit("20%").alias("tax_rate"),
        "nomenclature",
        localised(F.col("l_extendedprice")).alias("amount"),
        F.when(F.col("l_returnflag") == "A", F.lit("Возврат товаров"))
        .when(F.col("l_linestatus") == "O", F.lit("Реализация товаров"))
        .otherwise(F.lit("Реализация продукции"))
        .alias("contents_operation"),
    )
    path = scratch_path(spark, "sales-export")
    (
        export.write.option("header", True).option("sep", "\t").option("quote", '"')
        .option("escape", '"').option("lineSep", "\r\n").csv(path)
    )
    return cleanse_sales(read_delimited(spark, path, SALES_EXPORT_SCHEMA))


def src_exports_with_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their export names plus the flags that decide whether
    a line is a sale in the export."""
    customer = read_table(spark, sf_dir, "customer")
    supplier = read_table(spark, sf_dir, "supplier")
    orders = read_table(spark, sf_dir, "orders")
    part = read_table(spark, sf_dir, "part")
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_partkey", F.col("l_shipdate").alias("dt"),
        F.col("l_quantity").cast("int").alias("quantity"), "l_extendedprice",
        "l_returnflag", "l_linestatus",
    )
    lines = left_lookup(
        lines,
        left_lookup(orders.select("o_orderkey", "o_custkey", "o_orderpriority"), customer,
                    {"o_custkey": "c_custkey"}, {"c_name": "c_name"}),
        {"l_orderkey": "o_orderkey"},
        {"c_name": "counterparty", "o_orderpriority": "contract"},
    )
    lines = left_lookup(lines, supplier, {"l_suppkey": "s_suppkey"}, {"s_name": "company"})
    return left_lookup(lines, part, {"l_partkey": "p_partkey"}, {"p_brand": "nomenclature"})


CLEANSE_EXPORTS_SQL = """
SELECT l.l_shipdate AS dt, s.s_name AS company,
       replace(c.c_name, '#', ' #') AS counterparty,
       o.o_orderpriority AS contract, p.p_brand AS nomenclature,
       CAST(l.l_quantity AS INTEGER) AS quantity,
       CAST(trunc(l.l_extendedprice) AS INTEGER) AS amount
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_returnflag NOT IN ('R', 'A')
"""


def many_file_ingest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template (city ``c_``, one row per customer) copied into ten
    files with ``c_`` -> ``c_<copy>``, loaded as one glob with serial ids,
    then the rows of city ``c_1``."""
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from starload.operators.filters import filter_equals
    from starload.operators.keys import assign_keys
    from starload.sources.files import read_glob
    from starload.sources.generate import expand_template

    template = read_table(spark, sf_dir, "customer").select(
        F.lit("c_").alias("city"),
        F.col("c_name").alias("manager"),
        F.col("c_mktsegment").alias("product"),
        F.col("c_nationkey").alias("val"),
    )
    copies = expand_template(template, "city", "c_", 10)
    path = scratch_path(spark, "many-files")
    # one folder per copy: data_<step>; a task has a bounded part of one copy
    (
        copies.hint("rebalance", "step").write.partitionBy("step").option("header", True).csv(path)
    )
    schema = StructType([StructField("city", StringType()), StructField("manager", StringType()),
                         StructField("product", StringType()), StructField("val", IntegerType())])
    loaded = read_glob(spark, f"{path}/step=*/*.csv", schema)
    keyed = assign_keys(loaded, ["city", "manager"], id_col="sale_id")
    return filter_equals(keyed, "city", "c_1")


MANY_FILE_INGEST_SQL = """
WITH copies AS (
  SELECT 'c_' || CAST(step AS VARCHAR) AS city, c_name AS manager, c_mktsegment AS product,
         c_nationkey AS val
  FROM customer, range(1, 11) r(step)),
keyed AS (
  SELECT CAST(row_number() OVER (ORDER BY city, manager, product, val) AS BIGINT) AS sale_id, *
  FROM copies)
SELECT * FROM keyed WHERE city = 'c_1'
"""


def project_columns_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starload.operators.filters import project

    return project(read_table(spark, sf_dir, "lineitem"), ["l_partkey", "l_orderkey", "l_tax"])


PROJECT_COLUMNS_SQL = "SELECT l_partkey, l_orderkey, l_tax FROM lineitem"


def rename_positional_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starload.operators.filters import rename_positional

    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderdate", "o_custkey", "o_orderkey", "o_totalprice")
    return rename_positional(orders, ["dt", "client_id", "product_id", "amount"])


RENAME_POSITIONAL_SQL = """
SELECT o_orderdate AS dt, o_custkey AS client_id, o_orderkey AS product_id,
       o_totalprice AS amount FROM orders
"""
