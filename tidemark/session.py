"""Session helpers: building a session, pinning UTC, and the shared scratch area.

On a cluster the scratch area is the folder named by ``spark.checkpoint.dir``
(shared storage).  Only when that setting is absent *and* the master is local
(tests, laptops) do we create a private temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Materialised lookup tables and histograms are removed once no plan refers to them.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    pin_utc(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """All epoch and window arithmetic in this package assumes a UTC session."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; created privately only for local masters."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running tidemark jobs")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint area."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tidemark-scratch/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so local tests can inspect written files."""
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_dir(path: str) -> None:
    os.makedirs(local_path(path), exist_ok=True)
