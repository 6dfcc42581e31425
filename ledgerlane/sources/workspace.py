"""Where jobs may write: the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    Where it is unset, a temporary folder is made, but only for a local
    session: on a cluster other machines could not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="ledgerlane-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_run_folder(spark: SparkSession, purpose: str) -> str:
    """A path no other run uses, below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
