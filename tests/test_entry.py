"""The entry module from another working directory."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
python = [n for n in entry.queries() if n.startswith(("op1_", "op9_"))] or ["currency_convert"]
for name in python:
    print(name, entry.queries()[name](spark, sys.argv[2]).count())
print("flagship", entry.entry(spark).count())
"""


def test_queries_run_from_any_folder(tmp_path):
    """Python workers find the package although nothing on their path has it."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, os.path.join(ROOT, "__spark_entry__.py"), "/root/testdata/sf0.001"],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600,
    )
    if out.returncode:
        pytest.fail(out.stderr[-3000:])
    counts = dict(line.rsplit(" ", 1) for line in out.stdout.splitlines())
    assert int(counts["flagship"]) > 0 and all(int(n) > 0 for n in counts.values())
