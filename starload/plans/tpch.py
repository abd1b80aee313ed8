"""The warehouse operators applied to the driver's TPC-H-style tables.

Mapping used throughout (the driver tables stand in for the accounting
exports): the sales fact is ``lineitem``; the seller *company* is the
supplier's nation and the buying *counterparty* the customer's nation (the
same ``nation`` table in two roles); the *contract* is the order priority;
the *nomenclature* is the part brand.  A fact row is *actual* when the line
is open (``l_linestatus = 'O'``); returned lines (``l_returnflag = 'R'``)
carry an unknown (NULL) flag, so ``IS TRUE`` semantics are exercised.

Quantities are whole numbers and amounts are integer cents, so sums are
exact in every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.operators.aggregates import sum_by
from starload.operators.joins import left_lookup
from starload.session import read_table


def actual_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actual rows of ``lineitem`` in the stage-fact shape.

    A flag that is TRUE means an open line that was not returned; as plain
    comparisons of stored columns both conditions reach the scan.
    """
    li = read_table(spark, sf_dir, "lineitem")
    not_returned = (F.col("l_returnflag") != "R") | F.col("l_returnflag").isNull()
    return li.where(not_returned & (F.col("l_linestatus") == "O")).select(
        "l_orderkey",
        "l_suppkey",
        "l_partkey",
        F.col("l_shipdate").alias("dt"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("amount"),
    )


def sales_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of quantity and amount per company, counterparty, contract, item.

    Plan: the order -> customer snowflake is collapsed first (orders is far
    smaller than the fact); the fact, filtered to actual rows, takes the
    high-cardinality lookups (order, supplier, part) and is then aggregated
    on the resulting coarse keys (two nation ids, priority, brand: at most
    25 x 25 x 5 x 25 groups, whatever the scale) before the nation names are
    joined (eager aggregation: sums commute with the later left joins, fan-out
    included).  Only that small aggregate and the final regroup by name
    shuffle after the lookups.
    """
    fact = actual_lineitem(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority"
    )
    customer = read_table(spark, sf_dir, "customer")
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")
    part = read_table(spark, sf_dir, "part")

    order_party = left_lookup(
        orders, customer, {"o_custkey": "c_custkey"}, {"c_nationkey": "c_nationkey"}
    )
    fact = left_lookup(
        fact,
        order_party,
        {"l_orderkey": "o_orderkey"},
        {"c_nationkey": "counterparty_id", "o_orderpriority": "contract"},
    )
    fact = left_lookup(
        fact, supplier, {"l_suppkey": "s_suppkey"}, {"s_nationkey": "company_id"}
    )
    fact = left_lookup(fact, part, {"l_partkey": "p_partkey"}, {"p_brand": "nomenclature"})
    by_ids = sum_by(
        fact,
        ["company_id", "counterparty_id", "contract", "nomenclature"],
        {"quantity": "quantity", "amount": "amount"},
    )
    named = left_lookup(by_ids, nation, {"company_id": "n_nationkey"}, {"n_name": "company"})
    named = left_lookup(
        named, nation, {"counterparty_id": "n_nationkey"}, {"n_name": "counterparty"}
    )
    return sum_by(
        named,
        ["company", "counterparty", "contract", "nomenclature"],
        {"quantity": "total_quantity", "amount": "total_amount"},
    )


SALES_REPORT_SQL = """
SELECT sn.n_name AS company, cn.n_name AS counterparty,
       o.o_orderpriority AS contract, p.p_brand AS nomenclature,
       CAST(SUM(CAST(l.l_quantity AS INTEGER)) AS BIGINT) AS total_quantity,
       CAST(SUM(CAST(ROUND(l.l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS total_amount
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
WHERE (CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE l.l_linestatus = 'O' END) IS TRUE
GROUP BY 1, 2, 3, 4
"""
