"""Queries whose Python code runs in workers of several kinds, from a folder and an environment that do not know the package."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as e
for name in ("stream_dedupe", "stream_rights", "sql_split_ways", "snap_packed"):
    print("ROWS", name, e.queries()[name](spark, sys.argv[2]).count() > 0)
"""


def test_workers_find_the_package(data, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, str(ROOT), data], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.stdout.count("True") == 4, out.stderr[-2000:]
