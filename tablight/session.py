"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "tablight") -> SparkSession:
    """A local-mode session for tests and the bench (one JVM, `cores` threads)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TABLIGHT_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is used
    as is. Only when it is unset on a local master (tests) do we create a folder
    of our own; on any other master that raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get(CHECKPOINT_CONF, None)
    if not conf:
        try:
            conf = spark.conf.get(CHECKPOINT_CONF)
        except Exception:  # noqa: BLE001 - unset key
            conf = None
    if not conf and not sc.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    if not conf:
        conf = tempfile.mkdtemp(prefix="tablight-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf
