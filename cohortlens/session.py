"""Session helpers: local sessions for tests/bench, and checkpoint-directory discovery.

On a cluster the caller owns the session; nothing here overrides its settings except
that ``ensure_checkpoint_dir`` sets a directory when none is configured and the master
is local (tests). On a non-local master an unset ``spark.checkpoint.dir`` is an error:
a machine-local temporary folder would not survive the loss of an executor.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # zero-padded partition values must stay strings (yyyy / MM / dd)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # delete reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
                 max_shuffle_partitions: int = 100_000, broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Settings for a cluster run, sized from the bytes the jobs read and the cores available.

    * scan splits of ``target_partition_bytes`` (``files.maxPartitionBytes``), so a 100 TB scan is about
      400,000 tasks of a size that fits executor memory;
    * initial shuffle partitions from the input size (capped), then AQE coalesces small ones and splits
      skewed ones; the features jobs pre-aggregate before every shuffle, so shuffles are far smaller than
      the input;
    * broadcast only below ``broadcast_bytes`` as measured by Spark (no forced hints in the jobs);
    * runtime bloom filters let the installs side prune activity scans;
    * partition values stay strings (zero-padded dates), dynamic partition overwrite for upserts;
    * FAIR scheduling, so concurrently submitted fits share the executors instead of queueing.
    """
    n = max(2 * total_cores, min(max_shuffle_partitions, -(-input_bytes // target_partition_bytes)))
    conf = dict(LOCAL_CONF)
    conf.pop("spark.ui.enabled", None)
    conf.pop("spark.ui.showConsoleProgress", None)
    conf.update({
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        # the jobs submit independent fits concurrently (CV, k sweep); share executors between them
        "spark.scheduler.mode": "FAIR",
    })
    return conf


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cohortlens",
                  driver_memory: str = "16g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by ``spark.checkpoint.dir``.

    Only when it is unset *and* the master is local (tests, bench) do we create one.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="cohortlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint directory (never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df, name: str):
    """Write a frame once as parquet below the checkpoint directory and return it read back: for frames too large for a
    checkpoint, which stores rows uncompressed. Every reader gets the same rows, and only the columns it asks for."""
    import uuid

    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/queries/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def right_size(df, min_rows_per_partition: int = 50_000):
    """Coalesce (no shuffle) a materialised frame to at most ``ceil(rows / min_rows_per_partition)``
    partitions. Iterative ML runs several small jobs per iteration; on a small frame, many near-empty
    partitions only add scheduling overhead. Never increases the partition count, so large inputs keep
    the partitioning sized for the cluster. Costs one count (cheap on a checkpointed frame)."""
    import math

    current = df.rdd.getNumPartitions()
    target = max(1, math.ceil(df.count() / min_rows_per_partition))
    return df.coalesce(target) if target < current else df
