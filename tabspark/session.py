"""Session helpers.

Library code never creates its own session on a cluster: it receives one.
``local_session`` exists for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tabspark") -> SparkSession:
    """A local session for tests/bench: AQE on, UI off, UTC, Arrow on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize",
                os.environ.get("TABSPARK_MIN_PARTITION", "1m"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TABSPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Where it is unset, a scratch folder is made on a local master
    (tests); on a cluster that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get(CHECKPOINT_CONF, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.split("[")[0] == "local":
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tabspark-ckpt-")
    sc.setCheckpointDir(path)
    return path


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    For intermediates consumed by several branches of a plan (distinct
    value counts, score counts, scored tables): the upstream work runs
    once, and a lost executor re-reads the files instead of replaying the
    lineage. Never ``localCheckpoint``: executor-local blocks die with the
    executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for a cluster job over ``input_bytes`` of Parquet.

    * scan splits of ``target_partition_bytes`` (row groups permitting);
    * shuffle partitions so one partition is about that size after the
      largest shuffle (the per-order aggregate and the join on it are
      about the size of the projected input), never fewer than 2 waves of
      the cluster's cores; AQE coalesces the small shuffles of statistics;
    * AQE skew splitting for a join key that holds a large share of rows;
    * broadcast joins only below 64 MB of estimated size; bounded sides
      are hinted explicitly (see ``operators.joins.bounded_broadcast``).

    At 100 TB on 1000 executors x 8 cores: 400,000 scan splits and about
    400,000 shuffle partitions of about 256 MB each.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL settings (e.g. from ``cluster_conf``) on a session."""
    for k, v in conf.items():
        spark.conf.set(k, v)
