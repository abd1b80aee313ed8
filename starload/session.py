"""Session construction and shared-folder helpers.

Every job in the package gets its SparkSession from the caller; ``build_session``
is a convenience for tests, the bench and command-line use.  The settings that
matter for results (UTC session zone, ANSI mode) are set here so Spark and the
SQL oracle agree; the rest (AQE, skew handling) are performance defaults that a
cluster configuration may override.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "starload",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset, as
    in tests, a folder of the warehouse is used: every executor shares it as
    well, whereas a temporary folder of one machine would not outlive it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the setting
        sc = None
    if not configured and sc is not None:
        configured = sc.getCheckpointDir()
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/starload-scratch/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh Parquet table in the shared scratch folder and read it
    back: later steps read the columns they need of what was computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))

