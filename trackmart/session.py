"""Session defaults and the shared folder used to cut lineage.

On a cluster the operator names a shared, fault-tolerant folder in
``spark.checkpoint.dir``; trackmart reads it from the session and only sets
its own when it is unset (tests, local runs).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every trackmart job relies on. Timestamps are compared in UTC,
# AQE re-plans joins from measured sizes (broadcast only below
# ``spark.sql.adaptive.autoBroadcastJoinThreshold``) and splits skewed
# partitions of sort-merge joins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "trackmart",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    """Create (or get) a session with trackmart's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Reads ``spark.checkpoint.dir``. Only on a ``local`` master (a test or a
    laptop run) and only when it is unset, a fresh local folder is created
    and registered; on any other master the executors could not see such a
    folder, so a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local($|\[)", master):
        raise RuntimeError(f"master is {master}: set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="trackmart-ckpt-")
    spark.sparkContext.setCheckpointDir(local)  # the setting itself is fixed once the session runs
    return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder.

    The folder's scheme stays as configured, and all scratch folders of one
    application lie under one parent (``trackmart-<application id>``), which
    an operator can remove when the application is over.
    """
    return f"{checkpoint_dir(spark)}/trackmart-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint),
    so a lost executor does not force recomputation of a long lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
