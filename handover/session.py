"""Session helpers: a local session for tests/bench and the shared scratch folder.

On a cluster the session is created by the platform; the library only reads
settings from it. ``scratch_dir`` follows ``spark.checkpoint.dir`` (a shared
folder on a cluster) and only invents a local one when nothing is configured,
which is the test/bench situation.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "handover", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session configured the way the library expects a cluster to be."""
    parts = shuffle_partitions or (int(cores) if str(cores).isdigit() else os.cpu_count() or 8)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a skewed join partition even when that needs one more shuffle
        # (e.g. a hot item under the order-line aggregation on the item join)
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/ABFS)
    and is used as is; the fallback is for local tests and the bench.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="handover-ckpt-", dir="/tmp")
        spark.conf.set(CHECKPOINT_CONF, current)
    try:  # for DataFrame.checkpoint()
        spark.sparkContext.setCheckpointDir(current)
    except (AttributeError, NotImplementedError):  # a Spark Connect client has no context
        pass
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
