"""Session construction and the shared working folder.

Tables written by the library (snapshots, versioned tables, streaming
checkpoints) live under the folder named by ``spark.checkpoint.dir``: on a
cluster that is the shared folder every executor can reach.  Only when it is
unset (local runs, tests) do we create one of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "linepulse", driver_memory: str = "8g") -> SparkSession:
    """Session with the settings the operators are planned for."""
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared working folder (``spark.checkpoint.dir``).

    Read from the session.  When unset, a local run (tests) gets a fresh
    folder, registered as the checkpoint dir so ``checkpoint()`` works too;
    a cluster run fails rather than fall back to a machine-local folder.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="linepulse-")
        spark.conf.set(CHECKPOINT_CONF, root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique`` appends a fresh run id."""
    segs = [shared_dir(spark), "linepulse", *parts]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join(segs)


def cluster_conf(executors: int = 1000, cores_per_executor: int = 8) -> dict[str, str]:
    """Settings the operators are planned for at ~100 TB on a large cluster.

    * shuffle partitions ~ 4x total cores, AQE coalesces them down for the
      small aggregated stages and splits skewed ones (skew join);
    * 256 MB advisory partitions and 512 MB scan splits keep tasks in memory
      with room to spill;
    * broadcast joins are also decided at runtime on measured sizes.
    ``spark.checkpoint.dir`` must name a folder every executor can reach.
    """
    cores = executors * cores_per_executor
    return {
        "spark.sql.shuffle.partitions": str(4 * cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.files.maxPartitionBytes": str(512 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.session.timeZone": "UTC",
    }
