"""The folder that all executors share: cutting the lineage of iterations in it, and files for a query's own use."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's name below the session's shared one; on one machine, where none is set, a temporary folder that goes with the process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return f"{path.rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix=f"{name}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}/files"


def cut(df: DataFrame) -> DataFrame:
    """df, computed and checkpointed in the session's shared folder; on one machine, as in tests, in a temporary one where none is set."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(df.sparkSession.conf.get("spark.checkpoint.dir", None) or shared_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()
