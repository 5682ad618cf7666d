"""Where jobs keep their files.

Streaming checkpoints and intermediate layer tables must live on storage
every executor and the driver can reach.  The cluster names that folder in
``spark.checkpoint.dir``; we read it from the session and only set one when
it is unset in a local session (tests).
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.  A local session (tests) that
    names none gets a folder of its own, removed at exit; on a cluster a
    missing setting is an error, as executors don't share local folders."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="ticklake-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    return f"{shared_dir(spark)}/ticklake/{name}-{uuid.uuid4().hex[:12]}"
