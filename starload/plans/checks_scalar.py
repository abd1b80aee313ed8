"""Driver-table checks for the column functions, generators and calendar.

Each check builds its input from a driver table (so the work grows with the
table), applies one operator and returns the result; the matching DuckDB SQL
computes the expected values without the operator (from the clean value, by
integer arithmetic, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.dates import parse_date, parse_date_report, parse_timestamp
from starload.functions.numbers import cast_int, mixed_cell, parse_number, try_int
from starload.functions.text import NBSP, clean_all_text, clean_text
from starload.plans.calendar import date_dimension_for
from starload.session import read_table, scratch_path
from starload.sources.generate import (
    LCG_INCREMENT,
    LCG_MODULUS,
    LCG_MULTIPLIER,
    LCG_SHIFT,
    SALES_MANAGERS,
    SALES_PRODUCTS,
    SALES_VALUE_MAX,
    SALES_VALUE_MIN,
    expand_template,
    sales_from_keys,
)

# Whitespace mixed into the dirty text of the checks (tab, NBSP,
# em space, ideographic space, an ASCII separator, CR LF).
DIRTY_GAP = "\t\u00a0\u2003\u3000\x1c"
DIRTY_EDGE = "  \r\n"


def clean_text_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part")
    dirty = F.concat(
        F.lit(DIRTY_EDGE), F.col("p_name"), F.lit(DIRTY_GAP), F.col("p_brand"), F.lit(DIRTY_EDGE)
    )
    return part.select("p_partkey", clean_text(dirty).alias("clean"))


CLEAN_TEXT_SQL = """
SELECT p_partkey, p_name || ' ' || p_brand AS clean FROM part
"""


def clean_all_text_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit(NBSP), F.col("c_name"), F.lit("  ")).alias("c_name"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(DIRTY_GAP), F.lit("X")).alias(
            "c_mktsegment"
        ),
        "c_acctbal",
    )
    out = clean_all_text(customer, exclude=["c_name"])
    return out.select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("acctbal_cents"),
    )


CLEAN_ALL_TEXT_SQL = """
SELECT c_custkey, chr(160) || c_name || '  ' AS c_name, c_mktsegment || ' X' AS c_mktsegment,
       CAST(ROUND(c_acctbal * 100) AS BIGINT) AS acctbal_cents
FROM customer
"""


def _signed_price():
    return F.when(F.col("o_orderkey") % 2 == 0, -F.col("o_totalprice")).otherwise(
        F.col("o_totalprice")
    )


def parse_number_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals printed the way the exports print them, then parsed back."""
    orders = read_table(spark, sf_dir, "orders")
    text = F.replace(_signed_price().cast("string"), F.lit("."), F.lit(","))
    # thousands groups separated by NBSP, as in the exports
    text = F.regexp_replace(text, r"(\d)(?=(\d{3})+(,|$))", "$1" + NBSP)
    text = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(text)
    return orders.select("o_orderkey", parse_number(text).alias("parsed"))


PARSE_NUMBER_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE CAST(trunc(CASE WHEN o_orderkey % 2 = 0 THEN -o_totalprice ELSE o_totalprice END)
                      AS BIGINT) END AS parsed
FROM orders
"""


def parse_timestamp_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    text = F.date_format(F.col("ts"), "d.M.yyyy H:m:s")
    return events.select("event_id", parse_timestamp(text).alias("ts"))


PARSE_TIMESTAMP_SQL = """
SELECT event_id, date_trunc('second', ts) AS ts FROM events
"""


def _export_date_text():
    return F.when(F.col("o_orderstatus") == "P", F.lit("31.02.1999")).otherwise(
        F.date_format(F.col("o_orderdate"), "d.M.yyyy")
    )


def parse_date_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    iso = F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")
    return orders.select(
        "o_orderkey",
        parse_date(_export_date_text()).alias("dt"),
        parse_date(iso, "yyyy-MM-dd", strict=True).alias("dt_iso"),
    )


PARSE_DATE_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS dt,
       CAST(o_orderdate AS DATE) AS dt_iso
FROM orders
"""


def parse_date_report_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(_export_date_text().alias("dt_text"))
    return parse_date_report(orders, "dt_text")


PARSE_DATE_REPORT_SQL = """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE o_orderstatus <> 'P') AS parsed,
       CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS BIGINT) AS rejected,
       coalesce(bool_and(o_orderstatus <> 'P'), true) AS all_parsed
FROM orders
"""


def cast_int_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = read_table(spark, sf_dir, "lineitem")
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        cast_int(F.col("l_partkey").cast("string")).alias("partkey"),
        cast_int(F.col("l_suppkey")).alias("suppkey"),
    )


CAST_INT_SQL = """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS INTEGER) AS partkey,
       CAST(l_suppkey AS INTEGER) AS suppkey
FROM lineitem
"""


def try_int_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    text = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(
        F.col("c_custkey").cast("string")
    )
    return customer.select("c_custkey", text.alias("raw"), try_int(text).alias("value"))


TRY_INT_SQL = """
SELECT c_custkey,
       CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE CAST(c_custkey AS VARCHAR) END AS raw,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey AS INTEGER) END AS value
FROM customer
"""


def mixed_cells_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cells in one VARIANT column, written and read back: how many are
    integers and how many text, and what they add up to."""
    customer = read_table(spark, sf_dir, "customer")
    text = F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).when(F.col("c_custkey") % 7 == 0, None).otherwise(
        F.col("c_custkey").cast("string"))
    path = scratch_path(spark, "mixed")
    customer.select(mixed_cell(text).alias("cell")).write.parquet(path)
    cells = spark.read.parquet(path)
    return cells.groupBy(F.schema_of_variant("cell").alias("kind")).agg(
        F.count(F.lit(1)).alias("cells"),
        F.sum(F.try_variant_get("cell", "$", "int")).alias("total"),
        F.sum(F.length(F.col("cell").cast("string"))).alias("characters"),
    )


MIXED_CELLS_SQL = """
SELECT CASE WHEN raw IS NULL THEN NULL WHEN raw = c_name THEN 'STRING' ELSE 'BIGINT' END AS kind,
       count(*) AS cells, CAST(sum(CASE WHEN raw <> c_name THEN c_custkey END) AS BIGINT) AS total,
       CAST(sum(length(raw)) AS BIGINT) AS characters
FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 7 = 0 THEN NULL
                     ELSE CAST(c_custkey AS VARCHAR) END AS raw FROM customer)
GROUP BY 1
"""


def date_dimension_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar spanning every ship date of ``lineitem``."""
    return date_dimension_for(read_table(spark, sf_dir, "lineitem"), "l_shipdate")


DATE_DIMENSION_SQL = """
WITH b AS (SELECT min(CAST(l_shipdate AS DATE)) AS lo, max(CAST(l_shipdate AS DATE)) AS hi
           FROM lineitem),
d AS (SELECT CAST(lo + CAST(i AS INTEGER) AS DATE) AS date
      FROM b, range(0, datediff('day', lo, hi) + 1) r(i))
SELECT date,
       CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(day(date) AS INTEGER) AS day_of_month,
       CAST(dayofyear(date) AS INTEGER) AS day_of_year,
       CAST(dayofweek(date) AS INTEGER) AS day_of_week,
       dayname(date) AS day_name,
       strftime(date, '%a') AS day_short_name,
       CAST(weekofyear(date) AS INTEGER) AS week_number,
       CAST((day(date) - 1) // 7 + 1 AS INTEGER) AS week_of_month,
       CAST(date_trunc('week', date) AS DATE) AS week,
       CAST(month(date) AS INTEGER) AS month_number,
       monthname(date) AS month_name,
       strftime(date, '%b') AS month_short_name,
       CAST(date_trunc('month', date) AS DATE) AS first_day_of_month,
       last_day(date) AS last_day_of_month,
       CAST(quarter(date) AS INTEGER) AS quarter_number,
       'Q' || CAST(quarter(date) AS VARCHAR) AS quarter_name,
       CAST(date_trunc('quarter', date) AS DATE) AS first_day_of_quarter,
       CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
           AS last_day_of_quarter,
       CAST(year(date) AS INTEGER) AS year,
       CAST(year(date) // 10 * 10 AS INTEGER) AS decade,
       CAST(century(date) AS INTEGER) AS centurys
FROM d
"""


def generate_sales_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One synthetic sale per line item, keyed by order key and line number."""
    lineitem = read_table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return sales_from_keys(lineitem, key, "l_shipdate")


def picked_sales_sql(key: str) -> dict[str, str]:
    """SQL of what ``sales_columns`` picks from a key."""

    def pick(salt: int, modulus: int) -> str:
        x = f"(({key}) % {LCG_MODULUS})"
        return f"(((({x} * {LCG_MULTIPLIER} + {LCG_INCREMENT + salt}) % {LCG_MODULUS}) // {LCG_SHIFT}) % {modulus})"

    span = SALES_VALUE_MAX - SALES_VALUE_MIN + 1
    return {
        "manager": f"{list(SALES_MANAGERS)}[{pick(0, len(SALES_MANAGERS))} + 1]",
        "product": f"{list(SALES_PRODUCTS)}[{pick(1, len(SALES_PRODUCTS))} + 1]",
        "val": f"{pick(2, span)} + {SALES_VALUE_MIN}",
    }


SALES_PICKS = picked_sales_sql("l_orderkey * 8 + l_linenumber")

GENERATE_SALES_SQL = f"""
SELECT CAST(l_shipdate AS DATE) AS dt, {SALES_PICKS["manager"]} AS manager, {SALES_PICKS["product"]} AS product,
       CAST({SALES_PICKS["val"]} AS FLOAT) AS val
FROM lineitem
"""


def expand_template_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten copies of ``supplier``; in copy k the first ``#`` becomes ``#k``."""
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return expand_template(supplier, "s_name", "#", 10)


EXPAND_TEMPLATE_SQL = """
SELECT s_suppkey, regexp_replace(s_name, '#', '#' || CAST(step AS VARCHAR)) AS s_name,
       CAST(step AS INTEGER) AS step
FROM supplier, range(1, 11) r(step)
"""
