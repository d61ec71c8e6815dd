"""Session construction and the shared checkpoint / scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  Shuffle sizing is left to AQE: the initial
# partition count comes from the deployment and AQE coalesces small stages and
# splits skewed join partitions at run time.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Starting point for large clusters (hundreds of executors, tens of TB of input).
# Shuffles start wide and AQE merges small partitions toward the advisory size,
# so the same job also runs well on small inputs.  Skewed join partitions
# larger than 5x the median (and 256 MB) are split at run time.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.shuffle.service.enabled": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def build_session(master: str | None = None, app: str = "reelstats",
                  shuffle_partitions: int | None = None,
                  conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` is only given in tests and local runs; on a cluster the
    launcher decides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's value is always used when present, and required there.  Only
    local runs and tests without one get a fresh folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        # a folder of one machine serves only where driver and tasks share that machine
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="reelstats-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Used where a plan would otherwise recompute the same input several
    times.  The copy is on shared storage, so it survives executor loss and
    cuts the lineage; reading it back gives Spark exact sizes and, with
    ``partition_by``, partition pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with freed_shuffles(spark):
        writer.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Let Spark delete the shuffle files of the queries run inside as soon as each has ended.

    The written copy replaces them; otherwise they stay until the driver
    happens to collect its garbage, which on a long job is disk for nothing.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def free_unused(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffles and cached tables that nobody refers to any more.

    The cleaner learns of them when the driver collects its garbage, which a driver with
    a large heap seldom does.
    """
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no JVM at hand
        pass


def parts_for(df: DataFrame, times: float = 1.0, per_part: int = 64 << 20) -> int:
    """Partitions for a fixed-number shuffle of ``times`` the bytes of the tables that ``df`` scans.

    The configured number of shuffle partitions is the floor; larger tables get
    more, so that a task's share does not grow with the input.  Sources of unknown
    size (rows of the driver, RDDs) count for nothing.
    """
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no plan at hand
        return floor
    return max(floor, min(int(sum(x for x in sizes if x < 1 << 60) * times / per_part), 1 << 15))


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local-only helpers (tests)."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["BASE_CONF", "CLUSTER_CONF", "build_session", "checkpoint_dir", "scratch_path", "materialize",
           "free_unused", "parts_for", "local_path"]
