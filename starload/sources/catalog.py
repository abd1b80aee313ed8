"""SQL-side sources: parameterised SQL, literal rows, foreign tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def run_sql(spark: SparkSession, sql: str, **args) -> DataFrame:
    """Run SQL with named parameter markers (``:name``) bound to ``args``."""
    return spark.sql(sql, args=args or None)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Small inline tables (S6), for fixtures and parameters only."""
    return spark.createDataFrame(list(rows), schema)


def _quote(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def register_foreign_table(
    spark: SparkSession,
    local_name: str,
    remote_columns: Sequence[tuple[str, str]],
    provider: str,
    options: Mapping[str, str],
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Expose a remote table under a local name with local column names.

    Two temporary views: the inner one declares the *remote* columns on the
    data source (``USING jdbc`` with ``url``/``dbtable``, or a file format
    with ``path``), the outer one renames them.  Filters and projections on
    the local view still reach the source, because views are inlined.
    """
    rename = dict(rename or {})
    inner = f"{local_name}__remote"
    cols = ", ".join(f"`{n}` {t}" for n, t in remote_columns)
    opts = ", ".join(f"{k} {_quote(v)}" for k, v in options.items())
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW `{inner}` ({cols}) USING {provider} OPTIONS ({opts})"
    )
    select = ", ".join(f"`{n}` AS `{rename.get(n, n)}`" for n, _ in remote_columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{local_name}` AS SELECT {select} FROM `{inner}`")
    return spark.table(local_name)
