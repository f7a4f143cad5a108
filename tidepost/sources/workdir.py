"""A shared place for tables that cut lineage, stream checkpoints and sinks."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="tidepost-")


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets one temporary folder per process, and the session's
    settings stay as they are; on a cluster there is no safe default, because executors do not
    share the driver's disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_dir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses, below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
