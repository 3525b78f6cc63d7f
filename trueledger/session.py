"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(app: str = "trueledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's defaults; pass ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for tables a job writes and reads back.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only a session on this machine
    alone (``local`` master) may do without; elsewhere each executor would write to its own disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "trueledger-work")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def settled(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a result used several times: it is computed once, survives lost executors, and its size on
    disk lets the planner decide on broadcasting it.
    """
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
