"""The operators work where the executors' working folder does not hold the package."""

import os
import subprocess
import sys

import pytest

from tests.conftest import SF

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
for name, query in sorted(entry.queries().items()):
    if name.startswith("op"):
        assert query(spark, {SF!r}).collect(), name
print("shipped")
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "shipped" in done.stdout, done.stderr[-2000:]
