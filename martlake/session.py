"""Session construction and shared scratch locations.

Tables written by jobs (landing zones, curated data, dimension versions,
checkpoints) live below the folder the cluster names in
``spark.checkpoint.dir``.  That folder is shared storage on a cluster; where
the setting is absent, a local session (tests on a laptop) takes a temporary
folder and any other raises.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "martlake", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def without_old_shuffles(spark: SparkSession):
    """Within it a query's shuffle files are removed when the query ends, not when the driver happens to collect its
    garbage, so that the disks hold the tables and one step's shuffles."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def shared_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Reads ``spark.checkpoint.dir`` from the session.  Only in a local
    session without it a fresh local folder is made and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="martlake-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared root for one job's tables."""
    return f"{shared_root(spark)}/martlake-work/{uuid.uuid4().hex}/{name}"
