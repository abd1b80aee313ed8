"""Driver-table checks for sources and sinks: each writes driver data to a
fresh folder under the shared checkpoint folder and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from starload.operators.aggregates import sum_by
from starload.plans.checks_scalar import SALES_PICKS
from starload.session import read_table, scratch_path, table_path
from starload.sinks.files import bulk_load, export_csv, export_exact, export_split
from starload.sinks.tables import SnapshotTable, append_table
from starload.sources.catalog import register_foreign_table
from starload.sources.files import read_delimited, read_delimited_lenient, read_first_column, read_glob
from starload.sources.generate import sales_from_keys

CUSTOMER_SCHEMA = StructType(
    [
        StructField("c_custkey", LongType()),
        StructField("c_name", StringType()),
        StructField("c_nationkey", IntegerType()),
        StructField("c_acctbal", DoubleType()),
        StructField("c_mktsegment", StringType()),
    ]
)


def read_delimited_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers exported tab-separated with CRLF and inner quotes, read back."""
    customer = read_table(spark, sf_dir, "customer").withColumn(
        "c_name", F.concat(F.lit('ООО "'), F.col("c_name"), F.lit('"'))
    )
    path = scratch_path(spark, "tsv")
    (
        customer.write.option("header", True).option("sep", "\t").option("quote", '"')
        .option("escape", '"').option("lineSep", "\r\n").csv(path)
    )
    return read_delimited(spark, path, CUSTOMER_SCHEMA, sep="\t")


READ_DELIMITED_SQL = """
SELECT c_custkey, 'ООО "' || c_name || '"' AS c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer
"""


ORDERS_TEXT_SCHEMA = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
    ]
)


def _orders_in_files(spark, sf_dir, max_rows=1000):
    path = scratch_path(spark, "orders-csv")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    export_split(orders, path, max_rows)
    return path


def read_glob_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as many CSV files, read back as one set by glob."""
    path = _orders_in_files(spark, sf_dir)
    df = read_glob(spark, f"{path}/*.csv", ORDERS_TEXT_SCHEMA)
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total_cents"),
    )


READ_GLOB_SQL = """
SELECT o_orderstatus, count(*) AS orders,
       CAST(sum(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM orders GROUP BY o_orderstatus
"""


def export_split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No file above the row limit, no row lost."""
    limit = 1000
    path = _orders_in_files(spark, sf_dir, limit)
    df = read_glob(spark, f"{path}/*.csv", ORDERS_TEXT_SCHEMA).select(
        F.col("_metadata.file_path").alias("f")
    )
    per_file = df.groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.sum(F.when(F.col("n") > limit, 1).otherwise(0)).cast("bigint").alias("files_over_limit"),
        F.sum("n").alias("total_rows"),
    )


EXPORT_SPLIT_SQL = "SELECT CAST(0 AS BIGINT) AS files_over_limit, count(*) AS total_rows FROM orders"


EXACT_ROWS = 1000


def export_exact_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the order of their keys, in files of exactly 1,000 rows: what
    each file holds, numbered as the file names sort."""
    path = scratch_path(spark, "orders-exact")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    export_exact(orders, path, EXACT_ROWS, ["o_orderkey"])
    back = read_glob(spark, f"{path}/*.csv", ORDERS_TEXT_SCHEMA)
    file_no = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-", 1).cast("bigint")
    return back.groupBy(file_no.alias("file_no")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("total_cents"),
    )


EXPORT_EXACT_SQL = f"""
SELECT n // {EXACT_ROWS} AS file_no, count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
       CAST(sum(CAST(ROUND(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders) GROUP BY 1
"""


def read_first_column_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text file per nation: two lead lines, a header, then the names and
    balances of the nation's customers; the first column is read back."""
    nation = read_table(spark, sf_dir, "nation")
    customer = read_table(spark, sf_dir, "customer")
    lead = nation.select(
        F.col("n_nationkey").alias("file"),
        F.inline(
            F.array(
                F.struct(F.lit(0).cast("long").alias("line_no"),
                         F.concat(F.lit("Customers of "), F.col("n_name")).alias("text")),
                F.struct(F.lit(1).cast("long").alias("line_no"),
                         F.lit("generated\tby the accounting system").alias("text")),
                F.struct(F.lit(2).cast("long").alias("line_no"),
                         F.lit("Name\tBalance").alias("text")),
            )
        ),
    )
    body = customer.select(
        F.col("c_nationkey").alias("file"),
        (F.col("c_custkey") + 3).alias("line_no"),
        F.concat_ws("\t", F.col("c_name"), F.col("c_acctbal").cast("string")).alias("text"),
    )
    path = scratch_path(spark, "first-column")
    lines = lead.unionByName(body)
    (
        lines.repartition("file").sortWithinPartitions("file", "line_no")
        .select("file", F.col("text").alias("value"))
        .write.partitionBy("file").option("lineSep", "\r\n").text(path)
    )
    return read_first_column(spark, path, "name", skip_rows=2)


READ_FIRST_COLUMN_SQL = "SELECT c_name AS name FROM customer"


def foreign_table_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``supplier`` under a local table name and local column names."""
    register_foreign_table(
        spark,
        "vendors",
        [("s_suppkey", "BIGINT"), ("s_name", "STRING"), ("s_nationkey", "INT"),
         ("s_acctbal", "DOUBLE")],
        "parquet",
        {"path": table_path(sf_dir, "supplier")},
        rename={"s_suppkey": "vendor_id", "s_name": "vendor_name",
                "s_nationkey": "country_id", "s_acctbal": "balance"},
    )
    return spark.sql("SELECT vendor_id, vendor_name, balance FROM vendors WHERE country_id < 10")


FOREIGN_TABLE_SQL = """
SELECT s_suppkey AS vendor_id, s_name AS vendor_name, s_acctbal AS balance
FROM supplier WHERE s_nationkey < 10
"""


def append_table_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of ``orders`` appended to one table equal ``orders``."""
    orders = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "append")
    append_table(orders.where(F.col("o_orderstatus") == "F"), path)
    append_table(orders.where(F.col("o_orderstatus") != "F"), path)
    return spark.read.parquet(path)


APPEND_TABLE_SQL = "SELECT * FROM orders"


def replace_table_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version A then version B of a snapshot table; readers see B."""
    orders = read_table(spark, sf_dir, "orders")
    table = SnapshotTable(spark, scratch_path(spark, "snapshot"))
    table.replace(orders.where(F.col("o_orderstatus") == "F"))
    table.replace(orders.where(F.col("o_orderstatus") != "F"))
    return table.read()


REPLACE_TABLE_SQL = "SELECT * FROM orders WHERE o_orderstatus <> 'F'"


PART_TEXT_SCHEMA = StructType(
    [StructField("p_partkey", LongType()), StructField("label", StringType()),
     StructField("p_retailprice", DoubleType())]
)


def export_csv_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, commas and backslashes survive a CSV round trip."""
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit('"'), F.col("p_name"), F.lit('", '), F.col("p_brand"), F.lit("\\")).alias("label"),
        "p_retailprice",
    )
    path = scratch_path(spark, "export")
    export_csv(part, path)
    return read_delimited(spark, path, PART_TEXT_SCHEMA, sep=",")


EXPORT_CSV_SQL = """
SELECT p_partkey, '"' || p_name || '", ' || p_brand || '\\' AS label, p_retailprice FROM part
"""


def read_records_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line ends, quotes and separators, exported as they are and read
    back by tasks that each take a block of a file: what every document's text is."""
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit('"'), F.coalesce("text", F.lit("")), F.lit('"\n,\r\n')).alias("text"), "lang")
    path = scratch_path(spark, "records")
    export_csv(docs, path, multi_line=True)
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                         StructField("lang", StringType())])
    back = read_delimited(spark, path, schema, sep=",", multi_line=True)
    return back.select("doc_id", "lang", F.length("text").cast("long").alias("length"), F.md5("text").alias("digest"))


READ_RECORDS_SQL = """
SELECT doc_id, lang, CAST(length(t) AS BIGINT) AS length, md5(t) AS digest
FROM (SELECT doc_id, lang, '"' || coalesce(text, '') || '"' || chr(10) || ',' || chr(13) || chr(10) AS t FROM documents)
"""


def read_rejects_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as lines of which some have a field too many and some a balance
    that is no number; what is read, and what is kept apart and why."""
    text = F.concat_ws("\t", "c_custkey", "c_name", "c_nationkey", F.when(
        F.col("c_custkey") % 11 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")), "c_mktsegment")
    lines = read_table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 7 == 0, F.concat(text, F.lit("\tmore"))).otherwise(text).alias("value"))
    path = scratch_path(spark, "rejects")
    lines.write.text(path)
    good, bad = read_delimited_lenient(spark, path, CUSTOMER_SCHEMA, header=False)
    fields = F.size(F.split("_rejected", "\t"))
    told = bad.select(
        F.split("_rejected", "\t")[0].cast("bigint").alias("c_custkey"),
        F.when(fields > 5, "fields").otherwise("value").alias("reason"))
    return good.select("c_custkey", F.lit("read").alias("reason")).unionByName(told)


READ_REJECTS_SQL = """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'fields' WHEN c_custkey % 11 = 0 THEN 'value' ELSE 'read' END AS reason
FROM customer
"""


SALES_CSV_SCHEMA = StructType(
    [
        StructField("dt", StringType()),
        StructField("manager", StringType()),
        StructField("product", StringType()),
        StructField("val", FloatType()),
    ]
)


def _loaded_totals(spark: SparkSession, sf_dir: str, one_file: bool) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem")
    sales = sales_from_keys(lineitem, F.col("l_orderkey") * 8 + F.col("l_linenumber"), "l_shipdate")
    sales = sales.select(F.col("dt").cast("string").alias("dt"), "manager", "product", "val")
    files = scratch_path(spark, "sales-files")
    if one_file:
        export_csv(sales.repartition(1), files)  # only the write is in one task
    else:
        export_split(sales, files, 5000)
    loaded = bulk_load(spark, files, SALES_CSV_SCHEMA, scratch_path(spark, "sales-table"))
    return sum_by(
        loaded.withColumn("val", F.col("val").cast("bigint")).withColumn("n", F.lit(1)),
        ["manager", "product"],
        {"val": "total_val", "n": "rows"},
    )


def bulk_load_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic sales (one per line item) exported in files of at most 5,000
    rows, then bulk-loaded as one folder; totals per manager and product."""
    return _loaded_totals(spark, sf_dir, one_file=False)


def bulk_load_one_file_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sales from one file, the other side of the comparison."""
    return _loaded_totals(spark, sf_dir, one_file=True)


BULK_LOAD_SQL = f"""
SELECT {SALES_PICKS["manager"]} AS manager, {SALES_PICKS["product"]} AS product,
       CAST(sum({SALES_PICKS["val"]}) AS BIGINT) AS total_val, CAST(count(*) AS BIGINT) AS rows
FROM lineitem GROUP BY 1, 2
"""


def _table_name(prefix: str) -> str:
    import uuid

    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def typed_table_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed table with length limits and defaults; inserts omit the
    defaulted columns, which are filled in."""
    from starload.sinks.tables import create_tables

    name = _table_name("stage_orders")
    create_tables(
        spark,
        {name: "id BIGINT, status VARCHAR(1), priority VARCHAR(15), total DECIMAL(12,2), "
               "currency STRING DEFAULT 'RUB', is_actual BOOLEAN DEFAULT true"},
        locations={name: scratch_path(spark, "typed")},
    )
    read_table(spark, sf_dir, "orders").createOrReplaceTempView("orders_src")
    spark.sql(
        f"INSERT INTO {name} (id, status, priority, total) "
        "SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_totalprice AS DECIMAL(12,2)) "
        "FROM orders_src"
    )
    return spark.table(name)


TYPED_TABLE_SQL = """
SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority,
       CAST(o_totalprice AS DECIMAL(12,2)) AS total, 'RUB' AS currency, true AS is_actual
FROM orders
"""


def truncate_reload_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, truncate, load again: the table holds one copy (K7)."""
    from starload.sinks.tables import create_table_as, truncate_tables

    name = _table_name("src_orders")
    orders = read_table(spark, sf_dir, "orders")
    create_table_as(spark, name, orders, path=scratch_path(spark, "truncate"))
    truncate_tables(spark, [name])
    orders.write.insertInto(name)
    return spark.table(name)


TRUNCATE_RELOAD_SQL = "SELECT * FROM orders"


def create_table_as_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop-if-exists + create-as-select twice (K6): a table built from
    ``nation`` is replaced by the calendar spanning the ship dates (another
    schema)."""
    from starload.plans.calendar import date_dimension_for
    from starload.sinks.tables import create_table_as

    name = _table_name("date_dim")
    calendar = date_dimension_for(read_table(spark, sf_dir, "lineitem"), "l_shipdate")
    create_table_as(spark, name, read_table(spark, sf_dir, "nation"), path=scratch_path(spark, "ctas"))
    return create_table_as(spark, name, calendar, path=scratch_path(spark, "ctas"))
