"""Workers need nothing but what Spark sends them."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
PROGRAM = f"""
import sys
sys.path.insert(0, {REPO!r})  # the driver's path only: workers start from the environment, which lacks it
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
import __spark_entry__ as entry
seen = spark.sparkContext.parallelize([0], 1).map(lambda _: __import__("importlib.util").util.find_spec("scanforge") is not None).first()
print("WORKER SEES PACKAGE", seen)
print("ROWS", entry.entry(spark).count())
"""


def test_correction_without_the_package_on_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "WORKER SEES PACKAGE False" in done.stdout, done.stdout + done.stderr[-2000:]
    assert int(done.stdout.rpartition("ROWS ")[2]) > 0
