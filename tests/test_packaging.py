"""The package reaches executors that were not started with it on their path."""

import os
import subprocess
import sys

import pytest
from given import SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.checkpoint.dir", sys.argv[1]).config("spark.sql.shuffle.partitions", "2").getOrCreate()
sys.path.insert(0, sys.argv[2])
import __spark_entry__ as driver
for name in ("recommend_topk", "anomaly_iforest"):
    assert driver.queries()[name](spark, sys.argv[3]).count() > 0
"""


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables are not here")
def test_queries_run_from_an_empty_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path / "shared"), ROOT, SMALL], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
