"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "spark-revenue", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job assumes.

    Dates are compared in UTC, AQE handles skewed joins and partition sizes.  ``master`` is
    left to ``spark-submit`` on a cluster.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if named is None and context.master.startswith("local"):
            named = tempfile.mkdtemp(prefix="spark-revenue-")
        if named:
            context.setCheckpointDir(named)
    return context.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    """Where jobs keep tables that outlive executors: the checkpoint folder, else the warehouse."""
    return ensure_checkpoint_dir(spark) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"


def materialise(df: DataFrame) -> DataFrame:
    """Compute a frame once that several branches of a job read.

    A reliable checkpoint, or a table in the warehouse where a cluster names no checkpoint folder: both
    survive lost executors.
    """
    return df.checkpoint() if ensure_checkpoint_dir(df.sparkSession) else stored(df)


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """Compute a frame once as a table in the shared folder, of which each branch of a job reads its own columns."""
    path = path or f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
