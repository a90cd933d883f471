"""Session helpers: a local builder for tests/bench and shared scratch space.

Library code never creates its own session; it takes the caller's. The only
state it needs from the session is a *shared* scratch folder for the
operators that materialise intermediate files (CSV/Parquet conversion, raw
text ingest). That folder is ``spark.checkpoint.dir`` — on a cluster this
names shared storage (HDFS/S3/ABFS). Only on a local master, where the driver
machine *is* the cluster, do we fall back to a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "hackney") -> SparkSession:
    """A local session tuned for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, setting one only if unset.

    A cluster must name shared storage in ``spark.checkpoint.dir``; we refuse
    to invent a machine-local folder there. In local mode an unset value gets
    a fresh temporary folder (the driver's disk is the whole cluster).
    """
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if current:
        return current
    if not _is_local(spark):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is unset: set it to a shared folder "
            "(e.g. hdfs:///tmp/checkpoints) so intermediate tables survive "
            "executor loss")
    path = tempfile.mkdtemp(prefix="hackney-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder name under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "hackney", *parts, uuid.uuid4().hex])


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
