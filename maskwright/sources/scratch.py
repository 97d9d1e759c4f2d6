"""The shared folder for data that cuts lineage or passes between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which all executors can reach.

    A session on local threads that names none gets a temporary one; a cluster
    without one is an error, because a machine-local folder is lost to others.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="maskwright-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder path of its own below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark).rstrip('/')}/maskwright/{name}-{uuid.uuid4().hex}"
