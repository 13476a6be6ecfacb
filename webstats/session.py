"""SparkSession construction and cluster-facing settings.

Everything in the library is lazy; the only things configured here are the
runtime knobs that matter at scale: AQE (runtime coalescing, skew-join
splitting, runtime broadcast conversion), UTC session time, Arrow transfer for
the few pandas UDFs, and the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied to every session we build. AQE's skew handling splits a hot
# join partition (one key holding a third of the rows) into several tasks.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
}


def build_session(master: str | None = None, app: str = "webstats",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_tb: float, total_cores: int, target_partition_mb: int = 256,
                 max_shuffle_partitions: int = 50_000) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_tb`` terabytes of Parquet.

    Scan splits of ``target_partition_mb`` keep a task's input in memory; the
    initial shuffle partition count is sized so the widest shuffle (roughly the
    input of the raw-table aggregates) lands near the same size per partition,
    at least three waves of tasks over all cores, and capped so the number of
    shuffle blocks (map tasks x reduce partitions) stays manageable. AQE then
    coalesces small partitions and splits skewed ones at run time.
    """
    want = int(input_tb * 1024 * 1024 / target_partition_mb)
    shuffle_parts = max(3 * total_cores, min(want, max_shuffle_partitions))
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_partition_mb}m",
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{target_partition_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * target_partition_mb}m",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.2",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A local temporary folder is only used in local mode (tests); on a cluster a
    missing setting is an error, since executors do not share the driver's disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="webstats-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), "webstats", name)
