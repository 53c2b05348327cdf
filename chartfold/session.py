"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Digests and HMAC pads are at least 64 hex digits long; this hides them in plans and logs.
REDACTION = r"(?i)(0x)?[0-9a-f]{64,}"


def local_session(cores: int | str = 8, app: str = "chartfold") -> SparkSession:
    """Session for tests and the benchmark. On a cluster use the session you are given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("CHARTFOLD_DRIVER_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        # Listing local folders takes no job of its own.
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
        .config("spark.sql.redaction.string.regex", REDACTION)
        .getOrCreate()
    )


def hide_secrets(spark: SparkSession) -> None:
    """Make plans of this session print no key material."""
    spark.conf.set("spark.sql.redaction.string.regex", REDACTION)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder: on a cluster, a folder of
    one machine would lose data with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chartfold-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
