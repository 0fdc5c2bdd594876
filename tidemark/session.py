"""Session settings the operators rely on, and the shared folder they cut lineage to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # no Python call site per column expression; building large plans is several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; `conf` keys use `__` for `.`.

    Shuffle partitions, executor memory and the checkpoint folder belong to the
    cluster, so they are left to its defaults unless passed in.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local one only for a local master without any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not re.match(r"local(\[|$)", sc.master):  # local-cluster has other processes
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            configured = tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: partitions keep their rows and order even if executors are lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
