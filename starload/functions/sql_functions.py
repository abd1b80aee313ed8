"""SQL functions: scalar lookup, verdict, table functions, views.

All are SQL-bodied temporary functions, which the analyzer inlines into the
calling query (a scalar subquery becomes a left join), so nothing runs per row
in Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# The two verdict texts ("plan met" / "plan not met").
PLAN_MET = "План выполнен"
PLAN_NOT_MET = "План не выполнен"


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def plan_verdict(val_fact: str | Column, val_plan: str | Column) -> Column:
    """``fact - plan >= 0`` -> met; anything else, NULL included -> not met."""
    fact = F.col(val_fact) if isinstance(val_fact, str) else val_fact
    plan = F.col(val_plan) if isinstance(val_plan, str) else val_plan
    return F.when((fact - plan) >= 0, F.lit(PLAN_MET)).otherwise(F.lit(PLAN_NOT_MET))


def register_lookup(
    spark: SparkSession,
    name: str,
    table: str,
    key: str,
    value: str,
    key_type: str = "BIGINT",
    value_type: str = "BIGINT",
) -> None:
    """``name(p)`` = the ``value`` of ``table`` where ``key = p``.

    Several matches would make a scalar subquery fail, so the body takes the
    largest value; no match gives NULL.
    """
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(p {key_type})
            RETURNS {value_type}
            RETURN (SELECT max(t.{value}) FROM {table} t WHERE t.{key} = p)"""
    )


def register_verdict(spark: SparkSession, name: str = "plan_verdict") -> None:
    """``name(val_fact, val_plan)`` returning the verdict text."""
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(val_fact BIGINT, val_plan BIGINT)
            RETURNS STRING
            RETURN CASE WHEN val_fact - val_plan >= 0 THEN {_sql_text(PLAN_MET)}
                        ELSE {_sql_text(PLAN_NOT_MET)} END"""
    )


def register_plan_report(
    spark: SparkSession,
    name: str = "plan_report",
    plan_table: str = "plan",
    fact_table: str = "fact",
    key: str = "id",
    value: str = "val_fact",
    verdict: str = "plan_verdict",
) -> None:
    """Table function ``name(param)``: plan rows with looked-up fact and the
    verdict, only where the verdict equals ``param`` (U3).

    The lookup stands as a join: a scalar function called in the row would be
    planned once for the row and once more for the filter on its verdict.
    """
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(param STRING)
            RETURNS TABLE (id BIGINT, manager STRING, val_plan BIGINT, val_fact BIGINT,
                           result STRING)
            RETURN SELECT * FROM (
                     SELECT id, manager, val_plan, val_fact,
                            {verdict}(val_fact, val_plan) AS result
                     FROM (SELECT p.id, p.manager, p.val_plan, f.val_fact
                           FROM {plan_table} p LEFT JOIN (
                             SELECT `{key}` AS found, max(`{value}`) AS val_fact FROM {fact_table} GROUP BY `{key}`
                           ) f ON f.found = p.id))
                   WHERE result = param"""
    )


def register_filter_table(
    spark: SparkSession,
    name: str,
    table: str,
    column: str,
    columns: Sequence[tuple[str, str]],
    param_type: str = "BIGINT",
) -> None:
    """Table function ``name(v)`` = rows of ``table`` with ``column = v`` (U4).

    ``columns``: (name, type) of the result, in order.
    """
    ddl = ", ".join(f"`{c}` {kind}" for c, kind in columns)
    cols = ", ".join(f"`{c}`" for c, _ in columns)
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION {name}(param {param_type})
            RETURNS TABLE ({ddl})
            RETURN SELECT {cols} FROM {table} WHERE `{column}` = param"""
    )


def filter_table_dynamic(spark: SparkSession, sql: str, **args) -> DataFrame:
    """Rows of a query whose text is made at run time (U5), with its values bound by
    ``EXECUTE IMMEDIATE ... USING``; set-based, no row loop."""
    using = ", ".join(f":{name} AS {name}" for name in args)
    return spark.sql(
        f"EXECUTE IMMEDIATE :__text{f' USING {using}' if using else ''}", args={"__text": sql, **args})


def create_report_view(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Named view over a query (U7); expanded by the analyzer at use."""
    df.createOrReplaceTempView(name)
    return spark.table(name)
