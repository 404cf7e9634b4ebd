"""Sessions: settings that the plans count on, and the package on every executor."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: ANSI stays on, so that overflow and bad casts are errors; adaptive execution splits skewed joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS and what else is given, and the package on its executors."""
    builder = SparkSession.builder.appName("millrace").config(map=SETTINGS | more)
    spark = (builder.master(master) if master else builder).getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once for a session.

    Only local workers that start in the package's folder, or have it on their path, find it by themselves.
    """
    root = Path(__file__).resolve().parent.parent
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    paths = [Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if re.fullmatch(r"local(\[[^\]]*\])?", context.master) and (root in paths or Path.cwd() == root):
        return
    # by its real name, which the JVM and the Python process share
    archive = Path(os.path.realpath(tempfile.mkdtemp())) / "millrace.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted((root / "millrace").rglob("*.py")):
            z.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    context._millrace_shipped = True
