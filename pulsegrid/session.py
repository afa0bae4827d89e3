"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings every job of this package relies on.  The partition count is only the
# starting point: adaptive execution merges small shuffle partitions and splits skewed ones.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(app: str, cores: int | str = "*", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in SQL_DEFAULTS.items():
        builder = builder.config(name, value)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for name, value in extra.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A session on one machine (master ``local``) without one gets a fresh local folder, remembered for the
    session and removed when Python ends.  On any other master the setting is required: executors do not see
    each other's disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("pulsegrid.shared.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        root = tempfile.mkdtemp(prefix="pulsegrid-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("pulsegrid.shared.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make reliable checkpoints possible without overriding what the cluster configured."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))
    return context.getCheckpointDir()
