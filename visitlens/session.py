"""SparkSession construction and the per-session settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# SQL settings that can be changed on a running session. Jobs call
# ``configure`` so results do not depend on who created the session.
RUNTIME_CONF = {
    # Dates, hours and minutes are formatted in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: broadcast conversion from real sizes, partition
    # coalescing for small reports, skew splitting for hot join keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "visitlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the UI off and AQE on.

    On a cluster leave ``master`` unset so spark-submit decides; size
    ``spark.sql.shuffle.partitions`` from the input (about 128-256 MB of
    shuffle data per partition) and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # reliable checkpoints are deleted once no DataFrame refers to them
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **RUNTIME_CONF,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
               stream_state: bool = False) -> dict[str, str]:
    """Settings for a cluster run, from the input size and the core count.

    Shuffle partitions start at about one per 256 MB of input (at least
    three waves of tasks) and AQE coalesces what turns out small; scans split
    files at the same size; a shuffle partition five times the median and
    over 512 MB counts as skewed and is split in joins. ``stream_state``
    moves stream state to RocksDB so large keyed state is not held on the
    JVM heap.
    """
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    conf = {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **RUNTIME_CONF,
    }
    if stream_state:
        conf["spark.sql.streaming.stateStore.providerClass"] = \
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    return conf


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; that value is used as is.
    Only when it is unset on a local master (tests) a private folder is
    created; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    current = spark.conf.get("visitlens.checkpoint.dir", None)
    if current:
        return current
    if not sc.master.startswith("local"):
        # executors on other machines cannot see a driver-local folder
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = tempfile.mkdtemp(prefix="visitlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("visitlens.checkpoint.dir", path)
    return path
