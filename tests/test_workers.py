"""Python workers that cannot import this package, as on a cluster."""

import os
import subprocess
import sys

from conftest import ROOT

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as contract
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").getOrCreate()
for name in ("relevance_scorer", "cosine_top_k", "embedding_dedup", "cosine_clusters"):
    print("rows", name, contract.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_functions_travel_with_their_code(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.count("rows ") == 4
