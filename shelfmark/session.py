"""Session settings for the jobs and the checkpoint folder they share."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Call-site capture for every column expression; it dominates the time to build a wide plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "shelfmark", master: str | None = None, **extra) -> SparkSession:
    """Session with the settings above; `extra` overrides (dots written as `__`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that `spark.checkpoint.dir` names.

    In local mode, where driver and executors are one process, a folder in the warehouse serves when
    none is named. A cluster without the setting is an error: no machine-local folder would do.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is not None:
        return root
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")


def checkpointed(df: DataFrame) -> DataFrame:
    """A frame cut from its lineage and kept in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint()


def together(spark: SparkSession, *parts: Callable) -> list:
    """Results of parts that do not need each other; the jobs of one use the cores that those of another leave idle.

    All have ended when it returns, or raises what the first one that failed did.
    """
    with ThreadPoolExecutor(max(1, len(parts))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(part)) for part in parts]
    return [part.result() for part in running]
