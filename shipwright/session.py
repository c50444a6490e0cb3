"""SparkSession construction and the few session-level settings the engine relies on."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job assumes. Timestamps in the data are zone-less, so the session
# zone is pinned to UTC to keep date arithmetic independent of the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "shipwright",
                  extra: dict | None = None) -> SparkSession:
    """Local or cluster session with the engine defaults; sizes are set for local masters only."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and is_local(master):
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)   # a cluster keeps its own number
        # local mode runs every task inside the driver JVM, so it gets the memory
        conf["spark.driver.memory"] = os.environ.get("SHIPWRIGHT_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers, unless their path already has it."""
    package = os.path.dirname(os.path.abspath(__file__))
    root, app = os.path.dirname(package), spark.sparkContext.applicationId
    master = spark.sparkContext.master
    # workers on this machine see the driver's working folder (local) or its PYTHONPATH (local-cluster too)
    seen = (is_local(master) and os.getcwd() == root) or (
        master.startswith("local") and root in os.environ.get("PYTHONPATH", "").split(os.pathsep))
    if app in _SHIPPED or seen:
        return
    name = os.path.basename(package)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), name), "zip", root, name))
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared filesystem and is used as is; a cluster without it is
    refused, for its executors couldn't see a folder made up here. Only local masters get
    a scratch folder when it is unset.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="shipwright-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def is_local(master: str) -> bool:
    """Whether all tasks run in the driver's process (``local-cluster`` has executors of its own)."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession, name: str) -> str:
    """A folder for materialised tables under the shared checkpoint root."""
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, name) if "://" not in root else f"{root.rstrip('/')}/{name}"
    return path
