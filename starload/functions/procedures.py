"""Procedures as SQL scripts: a compound statement with variables and branches,
run by Spark in place of a stored procedure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starload.operators.upsert import AUDIT_COLUMNS

#: Groups in which new rows are numbered side by side.
GROUPS = 4096


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def replace_range_script(
    spark: SparkSession,
    target: str,
    source: str,
    result: str,
    load_ts,
    mode: str = "append",
    start="1900-01-01",
    end="1900-01-01",
    location: str | None = None,
    dt_col: str = "dt",
) -> DataFrame:
    """The fact part of the load procedure (U6, M4) as one script.

    ``target`` is a table with ``id``, the columns of ``source`` and the audit
    columns; the script creates the table ``result`` as its next state, since a
    file table takes no update: all rows, those of the day range with
    ``is_actual`` false if ``mode`` is ``replace``, and the rows of ``source`` with
    ids after the largest one and one load time, a variable set once (C20).
    Returns ``result``.

    The new rows are numbered without a global window: within groups by a hash of
    the row, after the number of rows in the groups before (one row a group).
    """
    columns = [c for c in spark.table(target).columns if c not in ("id", *AUDIT_COLUMNS)]
    names = ", ".join(f"`{c}`" for c in columns)
    place = f" LOCATION '{location}'" if location else ""
    # no query ends the script: Spark would collect its rows to the driver
    spark.sql(
        f"""
        BEGIN
          DECLARE load_ts TIMESTAMP_NTZ DEFAULT CAST(:load_ts AS TIMESTAMP_NTZ);
          DECLARE first_day DATE DEFAULT CAST(:first_day AS DATE);
          DECLARE last_day DATE DEFAULT CAST(:last_day AS DATE);
          DECLARE last_id BIGINT DEFAULT 0;
          SET last_id = (SELECT coalesce(max(id), 0) FROM {_quoted(target)});
          IF :mode = 'replace' THEN
            CREATE TABLE {_quoted(result)} USING parquet{place} AS
            SELECT id, {names}, dt_create, dt_update,
                   CASE WHEN to_date(`{dt_col}`) BETWEEN first_day AND last_day THEN false
                        ELSE is_actual END AS is_actual
            FROM {_quoted(target)};
          ELSE
            CREATE TABLE {_quoted(result)} USING parquet{place} AS
            SELECT id, {names}, dt_create, dt_update, is_actual FROM {_quoted(target)};
          END IF;
          INSERT INTO {_quoted(result)}
          WITH grouped AS (
            SELECT {names}, pmod(xxhash64({names}), {GROUPS}) AS grp FROM {_quoted(source)}),
          sizes AS (SELECT grp, count(*) AS n FROM grouped GROUP BY grp),
          before AS (SELECT grp, sum(n) OVER (ORDER BY grp) - n AS earlier FROM sizes),
          placed AS (
            SELECT {names}, grp, row_number() OVER (PARTITION BY grp ORDER BY {names}) AS place FROM grouped)
          SELECT last_id + earlier + place AS id, {names}, load_ts, load_ts, true
          FROM placed JOIN before USING (grp);
        END
        """,
        args={"load_ts": str(load_ts), "mode": mode, "first_day": str(start)[:10], "last_day": str(end)[:10]},
    )
    return spark.table(result)
