"""Session helpers.

Cluster jobs take the session they are given.  ``local_session`` is for tests,
the bench and the command line: it pins the settings the operators rely on
(UTC session zone, AQE) and, only when nobody configured one, a checkpoint
folder under /tmp -- a local folder is never chosen for a non-local master.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def _export_package_path() -> None:
    """Local Python workers inherit the driver's environment; make this
    package importable there (a cluster ships it with ``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    parts = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *parts])


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "clickwave") -> SparkSession:
    _export_package_path()
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure_session(spark)
    checkpoint_dir(spark)
    return spark


def configure_session(spark: SparkSession) -> SparkSession:
    """Settings every job in this package assumes; safe to call repeatedly.

    The checkpoint folder is resolved lazily, by the jobs that write state
    (:func:`checkpoint_dir`), so batch jobs run on any session.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local master without that setting gets a fresh folder under /tmp.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"set {CHECKPOINT_CONF} to a folder shared by the cluster (HDFS/S3/...)")
    path = tempfile.mkdtemp(prefix="clickwave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set(CHECKPOINT_CONF, path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def streaming_checkpoint(spark: SparkSession, name: str) -> str:
    """Per-query streaming checkpoint location under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}"
