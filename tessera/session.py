"""Session construction and the shared scratch location.

Every job that must materialise data (round trips, stream sinks, lineage
cuts) writes below the folder the cluster names in ``spark.checkpoint.dir``.
That folder is shared by all executors; a machine-local temp folder is only
created when the session has no checkpoint dir at all (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every tessera job relies on: UTC wall clock, ANSI semantics,
# adaptive execution with skew splitting and partition coalescing.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # File listing of many partition folders: bounded task count per listing job.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


# Settings for the target scale (~100 TB input, ~1000 executors). Shuffle
# partitions start high and AQE coalesces them to ~256 MB each; scans split
# files into 256 MB tasks; broadcast needs a side under 64 MB (static
# estimate or, with AQE, the measured shuffle size); skewed join partitions
# over 4x the median (and 512 MB) are split.
CLUSTER_PROFILE = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Coalesce to the advisory size, not to the core count.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
    "spark.task.maxFailures": "8",
    "spark.stage.maxConsecutiveAttempts": "8",
}


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, profile: str = "local") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if profile == "cluster":
        conf.update(CLUSTER_PROFILE)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; set one only when unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a remote (Connect) session
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set for this session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    # Unset: only a local-mode session may fall back to a folder on this
    # host; on a cluster that folder would not be visible to the executors.
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, run-unique folder under the shared checkpoint root.

    All such folders of an application lie in one folder of its own, which is
    deleted when the application ends.
    """
    root = f"{checkpoint_root(spark).rstrip('/')}/tessera-{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        fs.mkdirs(path)
        fs.deleteOnExit(path)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df):
    """Reliable checkpoint (written to the shared dir), never a local one."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
