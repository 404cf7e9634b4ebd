import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])
os.environ["PYSPARK_PYTHON"] = sys.executable

from millrace.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.warehouse.dir": "/tmp/millrace-warehouse"}
    s = session("local[4]", **settings)
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()
