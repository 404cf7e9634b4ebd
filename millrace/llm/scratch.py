"""Written tables in the folder that all executors share; they cut lineage and outlive lost executors."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; where that is unset and all runs on one machine, as in tests, a local folder."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{os.path.join(tempfile.gettempdir(), 'checkpoints')}"
    return path.rstrip("/")


class Scratch:
    """One run's folder below the shared one."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/millrace/{name}-{uuid.uuid4().hex}"
        self._n = 0
        if not spark.conf.get("spark.checkpoint.dir", None):
            # a local folder of this process's own choice goes with it
            atexit.register(shutil.rmtree, self.root.removeprefix("file://"), ignore_errors=True)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def table(self, df: DataFrame, name: str = "table") -> DataFrame:
        """Write df as Parquet and read it again."""
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for df in tables:
            delete(self.spark, df._scratch_path)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
