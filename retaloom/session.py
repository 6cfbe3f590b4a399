"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the engine is designed for. A cluster may override any of
# them; nothing in the package depends on a particular value.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "retaloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder is used in local mode alone, where driver and
    executors are one process; on a cluster, also a local one, the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="retaloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that later passes read the very same rows."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def as_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Spark then knows the bytes of what was estimated from its inputs before, and decides
    by them how to join it; its derivation runs once. The table belongs to the
    query that made it: nothing is looked up by name later.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
