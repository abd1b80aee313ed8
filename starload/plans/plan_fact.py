"""Plan versus fact per manager (P5): lookup, verdict, filter on the verdict.

The DataFrame form looks the fact up once (one join) and reuses it for the
value, the verdict and the filter; the SQL-function form calls the lookup
three times, and Spark plans one join per call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.functions.sql_functions import (
    plan_verdict,
    register_plan_report,
    register_verdict,
)
from starload.operators.joins import scalar_lookup


def plan_with_fact(plan: DataFrame, fact: DataFrame) -> DataFrame:
    """Every plan row with ``val_fact`` and the verdict text (``sql3``)."""
    looked = scalar_lookup(plan, fact, "id", "val_fact")
    return looked.select(
        "id", "manager", "val_plan", "val_fact",
        plan_verdict("val_fact", "val_plan").alias("result"),
    )


def plan_report(plan: DataFrame, fact: DataFrame, verdict: str) -> DataFrame:
    """Only plan rows whose verdict equals ``verdict``."""
    return plan_with_fact(plan, fact).where(F.col("result") == F.lit(verdict))


def plan_report_sql(spark: SparkSession, plan: DataFrame, fact: DataFrame, verdict: str) -> DataFrame:
    """The same through SQL functions and the table function."""
    plan.createOrReplaceTempView("plan")
    fact.createOrReplaceTempView("fact")
    register_verdict(spark, "plan_verdict")
    register_plan_report(spark, "plan_report")
    return spark.sql("SELECT * FROM plan_report(:v)", args={"v": verdict})
