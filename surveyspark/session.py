"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job wants; a cluster launcher may override any of them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "surveyspark",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when a local session leaves it unset (tests) a fresh local folder is
    created and recorded in the session, so later calls agree; on a cluster a
    machine's own folder would not be seen by the others, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        d = tempfile.mkdtemp(prefix="surveyspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = checkpoint_dir(spark)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def materialize(df, name: str):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Used only where one artifact feeds several branches (the audit, the fold
    join): the branches then scan a column-pruned table instead of each
    re-deriving it, and the lineage is cut at a point that survives lost
    executors (unlike a local checkpoint). The files go with the session's end.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).deleteOnExit(at)
    return spark.read.parquet(path)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 executor_memory_gb: float = 16.0, target_partition_mb: int = 256) -> dict:
    """Partition sizing for a cluster run (pass to ``get_spark(extra=...)`` or spark-submit).

    * scan splits of ``target_partition_mb`` (``spark.sql.files.maxPartitionBytes``);
    * initial shuffle partitions = max(3 x total cores, input / target), so no
      post-shuffle partition starts much above the target even before AQE;
      AQE then coalesces small ones toward the same advisory size;
    * skew split: a partition 5x the median and above 4 x target is split;
    * the broadcast limit AQE uses at run time stays far below a task's memory
      share (executor memory / cores).
    """
    total_cores = max(1, executors * cores_per_executor)
    target = target_partition_mb * 1024 * 1024
    shuffle = max(3 * total_cores, -(-int(input_bytes) // target))
    per_task = executor_memory_gb * 1024 ** 3 / max(1, cores_per_executor)
    broadcast = int(min(256 * 1024 ** 2, per_task / 8))
    return {
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(target // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast),
    }
