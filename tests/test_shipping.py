"""Executors need no copy of the package: its functions travel by value."""

import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.path.insert(0, {home!r})
from pyspark.sql import SparkSession
from {module} import QUERIES
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
for name in {names!r}:
    assert QUERIES[name](spark, {data!r}).count() >= 0
"""


def run_apart(tmp_path, module, names, data="/root/testdata/sf0.001"):
    """Runs queries where only the driver can import the package: workers begin in another folder, without a path to it."""
    code = CODE.format(home=str(Path(__file__).resolve().parents[1]), module=module, names=names, data=data)
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=600)


def test_queries_run_apart(tmp_path):
    run_apart(tmp_path, "ledgerloom.plans.queries", ["account_codec", "receipt_forms", "storage_trie_roots", "record_streams", "freezer_items"])
