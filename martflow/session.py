"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  The session zone fixes day/hour cuts
# (dt, hr, create_date); AQE re-plans joins from runtime sizes and splits
# skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.schemaInference": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "martflow", extra: dict | None = None) -> SparkSession:
    """Return the active session or build one with :data:`BASE_CONF`.

    ``master`` and ``shuffle_partitions`` only matter when no session is
    active (tests, bench); on a cluster they come from spark-submit.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is given and points at shared storage.  Only
    when it is unset (local tests, the local bench) a folder of our own is
    created and registered, so later calls agree on it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="martflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str, fresh: bool = True) -> str:
    """A sub-folder of the checkpoint root for sink tables and stream state.

    ``fresh=True`` appends a unique suffix so that repeated runs of a
    registered query never see each other's output.
    """
    root = checkpoint_root(spark).rstrip("/")
    suffix = f"-{uuid.uuid4().hex[:12]}" if fresh else ""
    path = f"{root}/{name}{suffix}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path
