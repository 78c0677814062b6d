"""Session helpers.

Library code never creates its own cluster settings: it reads what the
session has.  ``local_session`` is only for tests, benchmarks and the
command line.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "twinline") -> SparkSession:
    """A local session configured like a small cluster (AQE on, UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # delete checkpoint files once their DataFrame is unreachable (the
        # trainer checkpoints every few rounds)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TWINLINE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir`` (or set
    on the context before).  It must be set: checkpoints have to survive
    executors.  ``local_session`` sets one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: checkpoints must survive executors")
        configured = os.path.join(tempfile.gettempdir(), f"twinline-{uuid.uuid4().hex}")  # one process, one machine
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
