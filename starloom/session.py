"""Session helpers: sane defaults, and the shared folder for written state.

Lineage is cut by tables written into the folder the cluster names in
``spark.checkpoint.dir``.  A folder of our own is created only when the setting
is absent *and* the master is local (tests, laptops); on a cluster a missing
setting is an error, never a machine-local fallback.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    # Broadcast only what is measured: no broadcast from static plan estimates
    # (a compressed file size can understate the in-memory size many times);
    # AQE may still broadcast a side whose materialised shuffle output is small,
    # and the library broadcasts keyed tables whose bytes it has measured.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(input_bytes: int, task_slots: int, partition_bytes: int = 128 << 20,
               max_shuffle_partitions: int | None = None) -> dict[str, str]:
    """Settings sized for one run over ``input_bytes`` of input on
    ``task_slots`` cores: scan splits and post-shuffle partitions of about
    ``partition_bytes`` (so a task's share fits executor memory and spills
    little), enough shuffle partitions for the whole input (AQE coalesces
    the small ones), skew splitting above four target partitions.
    ``max_shuffle_partitions`` bounds the partition count (none by default)."""
    shuffle = max(2 * task_slots, -(-input_bytes // partition_bytes))
    if max_shuffle_partitions:
        shuffle = min(shuffle, max_shuffle_partitions)
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def build_session(
    master: str | None = None,
    app_name: str = "starloom",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
    task_slots: int | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if input_bytes:
        conf.update(scale_conf(input_bytes, task_slots or 8))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is unset: name a folder every executor shares"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a written table, in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
