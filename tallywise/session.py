"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings every job in this library relies on. AQE re-plans joins at runtime
# (broadcast conversion from real sizes, skew splitting, partition coalescing);
# the session zone is pinned so that date parts and ISO texts are repeatable.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once the checkpointed DataFrame is unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tallywise", extra_conf: dict | None = None) -> SparkSession:
    """Return the active session or build one with the library's settings.

    On a cluster the submitter supplies master and sizing; locally (tests,
    bench) ``master`` defaults to ``local[*]``.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master is None and not SparkConf().contains("spark.master"):
        master = "local[*]"  # plain `python` run; spark-submit sets the master itself
    if master is not None:
        builder = builder.master(master)
    for k, v in {**BASE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TALLYWISE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and scratch tables.

    A cluster names it in ``spark.checkpoint.dir`` and that value is always
    used. Only when it is unset (a local test session) is a fresh local
    folder created and registered.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tallywise-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def stage_rows(df: DataFrame, name: str = "rows") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Used where a result is read several times and recomputing it is costly
    (parsed JSON, joined dimensions) or must not change between reads (positions
    derived from partition ids). Cuts the lineage, so a lost executor triggers no
    long recomputation, and unlike a checkpoint it is columnar: later
    steps read only the columns they need.
    """
    path = scratch_path(df.sparkSession, f"tallywise/staged/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
