"""Driver-table checks for joins, keys, quality gates, upserts and functions.

Unmatched keys, NULLs and duplicates are derived from the tables by meaning
(a market segment missing from a dimension, unknown flags for pending
orders), never by dropping input rows: every check reads its whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.sql_functions import (
    PLAN_MET,
    filter_table_dynamic,
    register_filter_table,
    register_lookup,
)
from starload.operators.aggregates import profile, row_count
from starload.operators.filters import between_days, filter_equals, is_true
from starload.operators.joins import left_lookup, orphans, scalar_lookup
from starload.operators.keys import assign_keys
from starload.operators.quality import (
    check_decimal,
    check_length,
    check_not_null,
    check_unique,
)
from starload.operators.upsert import (
    expire_unseen,
    initial_load,
    replace_range,
    upsert,
)
from starload.plans import plan_fact
from starload.session import read_table

# Load timestamps of the two loads in the upsert checks.
LOAD_1 = "2024-01-01 00:00:00"
LOAD_2 = "2024-02-01 00:00:00"


def _t(spark, sf_dir, name):
    return read_table(spark, sf_dir, name)


# ----------------------------------------------------------------------- joins


def left_lookup_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders resolved against the customers outside one segment; NULLs kept."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    dim = _t(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return left_lookup(orders, dim, {"o_custkey": "c_custkey"}, {"c_name": "customer_name"})


LEFT_LOOKUP_SQL = """
SELECT o.o_orderkey, o.o_custkey, c.c_name AS customer_name
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c
  ON o.o_custkey = c.c_custkey
"""


def composite_lookup_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events resolved on (user, type) against a dimension of large events."""
    events = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    dim = (
        _t(spark, sf_dir, "events")
        .where(F.col("value") > 50)
        .groupBy("user_id", "event_type")
        .agg(F.min("event_id").alias("first_big_event"))
    )
    return left_lookup(
        events, dim, ["user_id", "event_type"], {"first_big_event": "first_big_event"}
    )


COMPOSITE_LOOKUP_SQL = """
SELECT e.event_id, e.user_id, e.event_type, d.first_big_event
FROM events e LEFT JOIN (
  SELECT user_id, event_type, min(event_id) AS first_big_event
  FROM events WHERE value > 50 GROUP BY user_id, event_type) d
ON e.user_id = d.user_id AND e.event_type = d.event_type
"""


def role_playing_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier nation and customer nation of every line: one table, two roles."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    nation = _t(spark, sf_dir, "nation")
    orders = left_lookup(
        _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        _t(spark, sf_dir, "customer"),
        {"o_custkey": "c_custkey"},
        {"c_nationkey": "c_nationkey"},
    )
    li = left_lookup(li, _t(spark, sf_dir, "supplier"), {"l_suppkey": "s_suppkey"},
                     {"s_nationkey": "s_nationkey"})
    li = left_lookup(li, orders, {"l_orderkey": "o_orderkey"}, {"c_nationkey": "c_nationkey"})
    li = left_lookup(li, nation, {"s_nationkey": "n_nationkey"}, {"n_name": "supplier_nation"})
    li = left_lookup(li, nation, {"c_nationkey": "n_nationkey"}, {"n_name": "customer_nation"})
    return li.select("l_orderkey", "l_linenumber", "supplier_nation", "customer_nation")


ROLE_PLAYING_SQL = """
SELECT l.l_orderkey, l.l_linenumber, sn.n_name AS supplier_nation, cn.n_name AS customer_nation
FROM lineitem l
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey
"""


def scalar_lookup_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, the largest line quantity (several matches -> one value)."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey")
    lines = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_quantity").cast("int").alias("qty")
    )
    return scalar_lookup(orders, lines, ("o_orderkey", "l_orderkey"), "qty", "max_qty")


SCALAR_LOOKUP_SQL = """
SELECT o.o_orderkey, (SELECT max(CAST(l.l_quantity AS INTEGER)) FROM lineitem l
                      WHERE l.l_orderkey = o.o_orderkey) AS max_qty
FROM orders o
"""


def fk_orphans_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines whose order is missing from the non-pending orders."""
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parents = _t(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    return orphans(lines, parents, {"l_orderkey": "o_orderkey"})


FK_ORPHANS_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_orderstatus <> 'P' AND o.o_orderkey = l.l_orderkey)
"""


# ------------------------------------------------------------- keys, quality


def assign_keys_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return assign_keys(orders, ["o_orderdate", "o_orderkey"], start=1000)


ASSIGN_KEYS_SQL = """
SELECT CAST(1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS id,
       o_orderkey, o_orderdate
FROM orders
"""


def _orders_with_nulls(spark, sf_dir):
    """Pending orders have unknown price and priority."""
    o = _t(spark, sf_dir, "orders")
    pending = F.col("o_orderstatus") == "P"
    return o.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(pending, F.lit(None)).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.when(pending, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def check_not_null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _orders_with_nulls(spark, sf_dir)
    return check_not_null(df, df.columns)


CHECK_NOT_NULL_SQL = """
SELECT column_name, CAST(null_count AS BIGINT) AS null_count FROM (
  SELECT 'o_orderkey' AS column_name, 0 AS null_count
  UNION ALL SELECT 'o_custkey', 0
  UNION ALL SELECT 'o_orderstatus', 0
  UNION ALL SELECT 'o_totalprice', (SELECT count(*) FROM orders WHERE o_orderstatus = 'P')
  UNION ALL SELECT 'o_orderdate', 0
  UNION ALL SELECT 'o_orderpriority', (SELECT count(*) FROM orders WHERE o_orderstatus = 'P'))
"""


def profile_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(_orders_with_nulls(spark, sf_dir))


PROFILE_SQL = """
WITH n AS (SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus <> 'P') AS known
           FROM orders)
SELECT position, column_name, data_type, CAST(non_null AS BIGINT) AS non_null,
       CAST(total AS BIGINT) AS row_count
FROM n, (VALUES (0, 'o_orderkey', 'bigint', 0), (1, 'o_custkey', 'bigint', 0),
                (2, 'o_orderstatus', 'string', 0), (3, 'o_totalprice', 'double', 1),
                (4, 'o_orderdate', 'timestamp_ntz', 0), (5, 'o_orderpriority', 'string', 1))
     v(position, column_name, data_type, nullable),
     LATERAL (SELECT CASE WHEN nullable = 1 THEN known ELSE total END AS non_null)
"""


def row_count_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(_t(spark, sf_dir, "lineitem"))


ROW_COUNT_SQL = "SELECT count(*) AS row_count FROM lineitem"


def check_length_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return check_length(customer, {"c_name": 18, "c_mktsegment": 9})


CHECK_LENGTH_SQL = """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE length(c_name) > 18 OR length(c_mktsegment) > 9
"""


def check_unique_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_unique(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


CHECK_UNIQUE_SQL = """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""


def check_foreign_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("event_id", "user_id")
    parents = _t(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "BUILDING")
    return orphans(events, parents, {"user_id": "c_custkey"})


CHECK_FOREIGN_KEY_SQL = """
SELECT event_id, user_id FROM events e
WHERE e.user_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM customer c WHERE c.c_mktsegment <> 'BUILDING' AND c.c_custkey = e.user_id)
"""


def check_decimal_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals scaled by 1000 against NUMERIC(10,2)."""
    orders = _t(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_totalprice") * 1000).alias("scaled")
    )
    return check_decimal(orders, ["scaled"]).select("o_orderkey")


CHECK_DECIMAL_SQL = """
SELECT o_orderkey FROM orders
WHERE TRY_CAST(o_totalprice * 1000 AS DECIMAL(10,2)) IS NULL
"""


# ------------------------------------------------------------------- filters


def filter_equals_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_equals(_t(spark, sf_dir, "events"), "event_type", "click").select(
        "event_id", "user_id", "value"
    )


FILTER_EQUALS_SQL = "SELECT event_id, user_id, value FROM events WHERE event_type = 'click'"


def filter_is_true_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _t(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_returnflag") == "R", F.lit(None).cast("boolean")).otherwise(
        F.col("l_linestatus") == "O"
    )
    return li.where(is_true(flag)).select("l_orderkey", "l_linenumber", "l_partkey")


FILTER_IS_TRUE_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE (CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_linestatus = 'O' END) IS TRUE
"""


def between_days_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders")
    return orders.where(between_days("o_orderdate", "1997-03-01", "1997-03-31")).select(
        "o_orderkey", "o_orderdate"
    )


BETWEEN_DAYS_SQL = """
SELECT o_orderkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) >= DATE '1997-03-01' AND CAST(o_orderdate AS DATE) <= DATE '1997-03-31'
"""


def contains_any_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from starload.operators.filters import contains_all, contains_any

    part = _t(spark, sf_dir, "part")
    return part.where(contains_any("p_type", ["ECON", "SMALL"])).where(
        contains_all("p_name", ["r"])
    ).select("p_partkey", "p_type", "p_name")


CONTAINS_ANY_SQL = """
SELECT p_partkey, p_type, p_name FROM part
WHERE (contains(p_type, 'ECON') OR contains(p_type, 'SMALL')) AND contains(p_name, 'r')
"""


# --------------------------------------------------------------------- upsert


def _dimension_v1(spark, sf_dir):
    """Customers outside BUILDING loaded at LOAD_1; nation 0 already expired."""
    customer = _t(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "BUILDING")
    dim = initial_load(customer, ["c_name", "c_mktsegment"], LOAD_1)
    ids = customer.select("c_name", "c_nationkey")
    dim = dim.join(ids, "c_name").withColumn(
        "is_actual", F.col("c_nationkey") != 0
    ).drop("c_nationkey")
    return dim.select("id", "c_name", "c_mktsegment", "dt_create", "dt_update", "is_actual")


def _source_v2(spark, sf_dir):
    """Second load: nation 1 absent; negative balances lost their segment."""
    customer = _t(spark, sf_dir, "customer").where(F.col("c_nationkey") != 1)
    return customer.select(
        "c_name",
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .otherwise(F.col("c_mktsegment"))
        .alias("c_mktsegment"),
    )


def upsert_touch_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _dimension_v1(spark, sf_dir)
    return upsert(target, _source_v2(spark, sf_dir), ["c_name"], LOAD_2)


def upsert_type1_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = _dimension_v1(spark, sf_dir)
    merged = upsert(target, _source_v2(spark, sf_dir), ["c_name"], LOAD_2,
                    update_cols=["c_mktsegment"])
    return expire_unseen(merged, LOAD_2)


_UPSERT_BASE_SQL = f"""
WITH t AS (
  SELECT CAST(row_number() OVER (ORDER BY c_name, c_mktsegment) AS BIGINT) AS id, c_name,
         c_mktsegment, TIMESTAMP '{LOAD_1}' AS dt_create, TIMESTAMP '{LOAD_1}' AS dt_update,
         c_nationkey <> 0 AS is_actual
  FROM customer WHERE c_mktsegment <> 'BUILDING'),
s AS (
  SELECT c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_nationkey <> 1),
kept AS (
  SELECT t.id, t.c_name, {{segment}} AS c_mktsegment, t.dt_create,
         CASE WHEN s.c_name IS NOT NULL THEN TIMESTAMP '{LOAD_2}' ELSE t.dt_update END
             AS dt_update,
         t.is_actual
  FROM t LEFT JOIN s ON t.c_name = s.c_name),
fresh AS (
  SELECT CAST((SELECT max(id) FROM t) + row_number() OVER (ORDER BY s.c_name) AS BIGINT) AS id,
         s.c_name, s.c_mktsegment, TIMESTAMP '{LOAD_2}' AS dt_create,
         TIMESTAMP '{LOAD_2}' AS dt_update, true AS is_actual
  FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_name = s.c_name)),
u AS (SELECT * FROM kept UNION ALL SELECT * FROM fresh)
"""

UPSERT_TOUCH_SQL = _UPSERT_BASE_SQL.replace("{segment}", "t.c_mktsegment") + "SELECT * FROM u"

UPSERT_TYPE1_SQL = (
    _UPSERT_BASE_SQL.replace(
        "{segment}", "CASE WHEN s.c_name IS NOT NULL THEN s.c_mktsegment ELSE t.c_mktsegment END"
    )
    + f"""SELECT id, c_name, c_mktsegment, dt_create, dt_update,
       CASE WHEN dt_update < TIMESTAMP '{LOAD_2}' THEN false ELSE is_actual END AS is_actual
FROM u"""
)


def _orders_fact(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.select(
        (F.col("o_orderkey") + 1).alias("id"),
        F.col("o_orderdate").alias("dt"),
        "o_orderkey",
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount"),
        F.lit(LOAD_1).cast("timestamp_ntz").alias("dt_create"),
        F.lit(LOAD_1).cast("timestamp_ntz").alias("dt_update"),
        F.lit(True).alias("is_actual"),
    )


def replace_range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-deliver the March 1997 orders with doubled amounts, mode replace."""
    fact = _orders_fact(spark, sf_dir)
    o = _t(spark, sf_dir, "orders")
    new_rows = o.where(between_days("o_orderdate", "1997-03-01", "1997-03-31")).select(
        F.col("o_orderdate").alias("dt"),
        "o_orderkey",
        (F.round(F.col("o_totalprice") * 100).cast("bigint") * 2).alias("amount"),
    )
    return replace_range(fact, new_rows, LOAD_2, mode="replace",
                         start="1997-03-01", end="1997-03-31", order_cols=["o_orderkey"])


REPLACE_RANGE_SQL = f"""
WITH f AS (
  SELECT o_orderkey + 1 AS id, o_orderdate AS dt, o_orderkey,
         CAST(ROUND(o_totalprice * 100) AS BIGINT) AS amount,
         TIMESTAMP '{LOAD_1}' AS dt_create, TIMESTAMP '{LOAD_1}' AS dt_update,
         NOT (CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31')
             AS is_actual
  FROM orders),
n AS (
  SELECT CAST((SELECT max(o_orderkey) + 1 FROM orders)
              + row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS id,
         o_orderdate AS dt, o_orderkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) * 2 AS amount,
         TIMESTAMP '{LOAD_2}' AS dt_create, TIMESTAMP '{LOAD_2}' AS dt_update, true AS is_actual
  FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31')
SELECT * FROM f UNION ALL SELECT * FROM n
"""


def replace_range_script_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same replacement as a SQL script over tables; the new rows' ids are dense,
    in an order of the script's own, so that they stand as one range here."""
    import uuid

    from starload.functions.procedures import replace_range_script
    from starload.sinks.tables import create_table_as
    from starload.session import scratch_path

    tag = uuid.uuid4().hex[:10]
    orders = _t(spark, sf_dir, "orders")
    create_table_as(spark, f"facts_{tag}", _orders_fact(spark, sf_dir), path=scratch_path(spark, "facts"))
    orders.where(between_days("o_orderdate", "1997-03-01", "1997-03-31")).select(
        F.col("o_orderdate").alias("dt"),
        "o_orderkey",
        (F.round(F.col("o_totalprice") * 100).cast("bigint") * 2).alias("amount"),
    ).createOrReplaceTempView(f"march_{tag}")
    done = replace_range_script(
        spark, f"facts_{tag}", f"march_{tag}", f"facts_next_{tag}", LOAD_2, "replace", "1997-03-01", "1997-03-31",
        location=scratch_path(spark, "facts-next"))
    new = F.col("dt_create") == F.lit(LOAD_2).cast("timestamp_ntz")
    added = done.where(new).agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"),
                                F.count_distinct("id").alias("ids"))
    return done.drop("id").join(F.broadcast(added), new, "left")  # one row


REPLACE_RANGE_SCRIPT_SQL = f"""
WITH f AS (
  SELECT o_orderdate AS dt, o_orderkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) AS amount,
         TIMESTAMP '{LOAD_1}' AS dt_create, TIMESTAMP '{LOAD_1}' AS dt_update,
         NOT (CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31') AS is_actual
  FROM orders),
n AS (
  SELECT o_orderdate AS dt, o_orderkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) * 2 AS amount,
         TIMESTAMP '{LOAD_2}' AS dt_create, TIMESTAMP '{LOAD_2}' AS dt_update, true AS is_actual
  FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31')
SELECT *, NULL AS first_id, NULL AS last_id, NULL AS ids FROM f UNION ALL
SELECT *, (SELECT max(o_orderkey) + 2 FROM orders), (SELECT max(o_orderkey) + 1 FROM orders) + (SELECT count(*) FROM n),
       (SELECT count(*) FROM n) FROM n
"""


# --------------------------------------------------------- plan / functions


def _plan_and_fact(spark, sf_dir):
    """Plan = orders per customer before 1998, fact = orders from 1998 on."""
    o = _t(spark, sf_dir, "orders")
    c = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"),
                                             F.col("c_name").alias("manager"))
    before = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    plan = (
        o.where(before).groupBy(F.col("o_custkey").alias("id"))
        .agg(F.count(F.lit(1)).alias("val_plan"))
        .join(c, "id")
        .select("id", "manager", "val_plan")
    )
    fact = (
        o.where(~before).groupBy(F.col("o_custkey").alias("id"))
        .agg(F.count(F.lit(1)).alias("val_fact"))
        .join(c, "id")
        .select("id", "manager", "val_fact")
    )
    return plan, fact


_PLAN_FACT_SQL = """
WITH plan AS (
  SELECT o_custkey AS id, c_name AS manager, count(*) AS val_plan
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY o_custkey, c_name),
fact AS (
  SELECT o_custkey AS id, count(*) AS val_fact
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY o_custkey),
r AS (
  SELECT p.id, p.manager, CAST(p.val_plan AS BIGINT) AS val_plan,
         CAST(f.val_fact AS BIGINT) AS val_fact,
         CASE WHEN f.val_fact - p.val_plan >= 0 THEN 'План выполнен'
              ELSE 'План не выполнен' END AS result
  FROM plan p LEFT JOIN fact f ON p.id = f.id)
"""


def plan_verdict_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, fact = _plan_and_fact(spark, sf_dir)
    return plan_fact.plan_with_fact(plan, fact)


PLAN_VERDICT_SQL = _PLAN_FACT_SQL + "SELECT * FROM r"


def plan_report_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, fact = _plan_and_fact(spark, sf_dir)
    return plan_fact.plan_report(plan, fact, PLAN_MET)


PLAN_REPORT_SQL = _PLAN_FACT_SQL + "SELECT * FROM r WHERE result = 'План выполнен'"


def plan_report_sql_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, fact = _plan_and_fact(spark, sf_dir)
    return plan_fact.plan_report_sql(spark, plan, fact, PLAN_MET)


def sql_scalar_function_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT p.*, query_fact(p.id)`` through a registered SQL function."""
    plan, fact = _plan_and_fact(spark, sf_dir)
    plan.createOrReplaceTempView("plan")
    fact.createOrReplaceTempView("fact")
    register_lookup(spark, "query_fact", "fact", "id", "val_fact")
    return spark.sql("SELECT p.id, p.manager, p.val_plan, query_fact(p.id) AS val_fact FROM plan p")


SQL_SCALAR_FUNCTION_SQL = _PLAN_FACT_SQL + "SELECT id, manager, val_plan, val_fact FROM r"


def _sales_view(spark, sf_dir):
    events = _t(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("manager"),
        F.col("user_id").alias("val"),
    )
    events.createOrReplaceTempView("event_sales")


def table_function_filter_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    _sales_view(spark, sf_dir)
    register_filter_table(spark, "query_filter_table", "event_sales", "val",
                          [("id", "BIGINT"), ("manager", "STRING"), ("val", "BIGINT")])
    return spark.sql("SELECT * FROM query_filter_table(7)")


def dynamic_filter_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    _sales_view(spark, sf_dir)
    return filter_table_dynamic(
        spark, "SELECT id, manager, val FROM event_sales WHERE val = :v", v=7
    )


TABLE_FILTER_SQL = (
    "SELECT event_id AS id, event_type AS manager, user_id AS val FROM events WHERE user_id = 7"
)


def replace_range_delete_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard-delete variant: March 1997 orders removed, then re-delivered."""
    fact = _orders_fact(spark, sf_dir)
    o = _t(spark, sf_dir, "orders")
    new_rows = o.where(between_days("o_orderdate", "1997-03-01", "1997-03-31")).select(
        F.col("o_orderdate").alias("dt"),
        "o_orderkey",
        (F.round(F.col("o_totalprice") * 100).cast("bigint") * 2).alias("amount"),
    )
    return replace_range(fact, new_rows, LOAD_2, mode="replace", start="1997-03-01",
                         end="1997-03-31", order_cols=["o_orderkey"], delete=True)


REPLACE_RANGE_DELETE_SQL = f"""
WITH f AS (
  SELECT o_orderkey + 1 AS id, o_orderdate AS dt, o_orderkey,
         CAST(ROUND(o_totalprice * 100) AS BIGINT) AS amount,
         TIMESTAMP '{LOAD_1}' AS dt_create, TIMESTAMP '{LOAD_1}' AS dt_update, true AS is_actual
  FROM orders
  WHERE NOT (CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31')),
n AS (
  SELECT CAST((SELECT max(o_orderkey) + 1 FROM orders)
              + row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS id,
         o_orderdate AS dt, o_orderkey, CAST(ROUND(o_totalprice * 100) AS BIGINT) * 2 AS amount,
         TIMESTAMP '{LOAD_2}' AS dt_create, TIMESTAMP '{LOAD_2}' AS dt_update, true AS is_actual
  FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-03-31')
SELECT * FROM f UNION ALL SELECT * FROM n
"""
