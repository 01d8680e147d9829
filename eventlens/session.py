"""Spark session and shared-storage helpers.

The library never creates machine-local scratch space on a cluster: lineage is
cut with ``DataFrame.checkpoint()`` into the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is missing (unit tests,
local runs) do we pick a directory ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session defaults the operators are tuned for.  On a cluster these are
# normally set by the deployment; ``get_spark`` only fills in what is unset.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches for the few pandas UDFs (stemmer, html decode, clustering
    # tree); small enough that one batch of long documents fits in memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    # Lets the partial (map-side) group limit kick in for top-n-per-group
    # filters up to the multi-document token budget (1024 in the reference).
    "spark.sql.optimizer.windowGroupLimitThreshold": "4096",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "eventlens") -> SparkSession:
    """Return the active session, creating a local one when none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("EVENTLENS_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    # Unset: local/test session only.
    path = tempfile.mkdtemp(prefix="eventlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never ``localCheckpoint``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, for tables that feed the next round of a loop.

    A checkpoint keeps the size estimate of its plan, and a join multiplies the
    estimates of its sides: over some dozens of rounds that number alone takes
    minutes to work out.  What is read back has the size of its files.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/eventlens-round-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
