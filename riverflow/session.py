"""Spark session settings shared by the library, the tests and the bench.

Cluster jobs get their session from the platform; ``configure`` only fills in
settings the library relies on (UTC clock, AQE) and never overrides a value
the cluster already set.  ``checkpoint_dir`` reads the shared folder named in
``spark.checkpoint.dir`` and only invents one for local runs.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the transforms assume.  Broadcasts are decided on measured sizes
# only: no plan-time broadcast from file-size estimates (a compressed file
# can understate the in-memory size several times), while AQE turns a
# shuffled join into a broadcast once the finished stage of one side measures
# under 64 MB.  Skewed shuffle partitions are split.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}
# Streaming state stays in Spark's default (executor memory, checkpointed)
# store: the dedup state covers the 15-minute watermark only and the latest
# state holds one row per (station, measure), both small per executor.  A
# cluster with much larger state can set the RocksDB provider instead.


def configure(spark: SparkSession) -> SparkSession:
    """Apply DEFAULTS where the session has no value of its own."""
    for key, value in DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    # The clock must be UTC whatever the cluster default: every timestamp the
    # reference handles is a UTC instant.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "riverflow", event_log_dir: str | None = None) -> SparkSession:
    """Session for tests and the bench: local mode, UI off, scratch under /tmp."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    # catalog tables of local runs go to a scratch warehouse, never the cwd
    builder = builder.config("spark.sql.warehouse.dir",
                             tempfile.mkdtemp(prefix="riverflow-warehouse-", dir="/tmp"))
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir)
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    Only a local session without one (tests) gets a scratch folder; on a
    cluster a missing setting is an error, never a driver-local folder.
    Staged tables and streaming checkpoints always land in this folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        # A folder on the driver's disk is invisible to executors on other
        # machines: a cluster must name its shared folder.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    scratch = tempfile.mkdtemp(prefix="riverflow-ckpt-", dir="/tmp")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-path of the checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name if "://" in base else os.path.join(base, name)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the checkpoint folder and return
    the read-back frame: a lineage cut in the shared folder that, unlike an
    eager ``checkpoint()``, computes its input only once."""
    spark = df.sparkSession
    path = scratch_path(spark, f"stage/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


MB = 1024 * 1024
GB = 1024 * MB
TB = 1024 * GB
# Cap on reduce partitions of one shuffle: map tasks x reduce partitions is
# the number of shuffle blocks, which must stay manageable.
MAX_SHUFFLE_PARTITIONS = 100_000


def sizing(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.5) -> dict[str, str]:
    """Partition settings for an input of ``input_bytes`` on ``total_cores``.

    - scan splits of 128 MB, 512 MB beyond 10 TB (fewer, still streaming,
      tasks);
    - initial shuffle partitions for ~200 MB of shuffled data each (the
      shuffled volume estimated as ``shuffle_fraction`` of the input), at
      least two per core, at most MAX_SHUFFLE_PARTITIONS (partitions grow
      beyond 200 MB then); AQE coalesces small ones to the advisory size.
    """
    split = 512 * MB if input_bytes > 10 * TB else 128 * MB
    shuffled = max(1, int(input_bytes * shuffle_fraction))
    parts = -(-shuffled // (200 * MB))
    parts = max(2 * total_cores, min(MAX_SHUFFLE_PARTITIONS, parts))
    parts = -(-parts // total_cores) * total_cores  # whole waves
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
    }


def apply_sizing(spark: SparkSession, input_bytes: int, total_cores: int) -> dict[str, str]:
    """Set ``sizing`` values the session has not set explicitly."""
    applied = {}
    for key, value in sizing(input_bytes, total_cores).items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
            applied[key] = value
    return applied
