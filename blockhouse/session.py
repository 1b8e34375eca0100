"""Session settings and shared scratch locations.

All calendar logic in this package is written against TIMESTAMP_NTZ values that
hold UTC wall time, so results do not depend on the session time zone; the zone
is still pinned to UTC so that any LTZ value a caller passes in is read the same
way everywhere.
"""
from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench (the cluster supplies its own)."""
    spark = (
        SparkSession.builder.master(master)
        .appName("blockhouse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # local runs shuffle a few MB: let AQE keep several writer tasks for
        # partitioned outputs instead of merging everything into one
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings the operators rely on (idempotent, runtime-settable)."""
    conf = spark.conf
    conf.set("spark.sql.session.timeZone", "UTC")
    # '07' must stay the text '07', never become the int 7 (hour keys are padded).
    conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    shared_root(spark)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local session (tests, bench) that has none gets
    a private folder, registered as the checkpoint directory; on a cluster the
    setting is required, because executors don't share local folders.
    """
    root = spark.conf.get(_CKPT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {_CKPT_KEY} to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="blockhouse-ckpt-")
        spark.conf.set(_CKPT_KEY, root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused location under the shared folder."""
    return f"{shared_root(spark)}/blockhouse/{name}-{uuid.uuid4().hex[:12]}"
