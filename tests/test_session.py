"""That executors find the package, wherever the driver starts."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
RUN = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from millrace.session import session
spark = session({{master!r}}, **{{{{"spark.ui.enabled": "false", "spark.executor.memory": "600m"}}}})
spark.sparkContext.setLogLevel("OFF")

def found(batches):
    import pyarrow as pa
    import millrace.functions.texts, millrace.operators.windows
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([millrace.__file__] * batch.num_rows)], names=["path"])

print("FOUND", spark.range(4).mapInArrow(found, "path string").distinct().collect())
spark.stop()
"""


@pytest.mark.parametrize("master", ["local[2]", "local-cluster[2,1,800]"])
def test_python_tasks_find_the_package(tmp_path, master):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")} | {"PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1"}
    if master.startswith("local-cluster"):
        env["SPARK_SCALA_VERSION"] = "2.13"
        # the executors' logs go to work in Spark's home, which may not be writable
        home = tmp_path / "home"
        home.mkdir()
        import pyspark

        for p in Path(pyspark.__file__).parent.iterdir():
            if p.name != "work":
                (home / p.name).symlink_to(p)
        env["SPARK_HOME"] = str(home)
    out = subprocess.run([sys.executable, "-c", RUN.format(master=master)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "millrace.zip" in out.stdout, out.stderr[-1500:]
