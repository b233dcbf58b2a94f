"""Session helpers.

Library functions never create a session; they take DataFrames. These helpers
are for tests, the bench and the pipeline entry points.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every entry point wants. AQE re-plans joins and coalesces
# partitions from runtime statistics; skew-join splitting is on by default
# under AQE and kept explicit here.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # checkpoint files of collected DataFrames are removed, not left behind
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Starting point for a large cluster (~100 TB input, ~1000 executors with a
# few cores and 8-16 GB each). Scan splits of 512 MB keep the task count near
# 200k; shuffles start wide and AQE merges them towards 256 MB partitions,
# so a partition always fits an executor's memory and spills otherwise.
# Broadcasts stay capped at 64 MB (runtime size, checked by AQE); above that
# joins shuffle, and AQE splits skewed partitions.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "100000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.shuffle.compress": "true",
    "spark.checkpoint.compress": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "stockflow",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    Uses ``spark.checkpoint.dir`` as the cluster names it. Only when a local
    session has none (tests) is a private folder created and set; a cluster
    session without the setting is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError(
                f"spark.checkpoint.dir is not set: on {sc.master} it must name a folder that the driver and all executors share"
            )
        configured = tempfile.mkdtemp(prefix="stockflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for a scratch table beside the checkpoints (shared storage)."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "stockflow-scratch", name)


#: Rows that one task of an explicitly dealt shuffle gets, about.
TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """How many partitions a shuffle of ``rows`` rows is dealt to: about
    ``TASK_ROWS`` rows each, so that a task's memory does not grow with the
    input, and no fewer than ``spark.sql.shuffle.partitions``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def deal(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by a hash of ``columns`` to tasks of
    a bounded number of rows, if the session's shuffle partitions are too few
    for that; else as it is, and a join or an aggregate deals it."""
    tasks = tasks_for(df.sparkSession, rows)
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartition(tasks, *columns)
    return df


#: Removes the shuffle files of an execution when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, drop_shuffles: bool = False) -> DataFrame:
    """Checkpoint ``df`` into the session's shared checkpoint folder (eager):
    the lineage is cut, later readers share one computed copy, and a lost
    executor re-reads it instead of recomputing the upstream plan.

    With ``drop_shuffles`` the shuffle files written on the way are removed as
    soon as the checkpoint stands, rather than when the driver next collects
    its garbage, so they don't add up over the steps of a query. They belong to
    this execution alone: ``df`` itself can still be read."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    if not drop_shuffles:
        return df.checkpoint(eager=True)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        # an execution takes the setting over when its DataFrame is made
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
