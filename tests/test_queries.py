import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from ledgerloom.plans import queries
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    same(spark, queries.QUERIES[name], queries.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 16
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rest_stands_without_llm(tmp_path):
    """The two llm folders deleted, with and without corpus_pipeline.py: the others' queries and SQL are all there."""
    home = Path(entry.__file__).resolve().parent
    copy = tmp_path / "repo"
    shutil.copytree(home, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    for folder in ("ledgerloom/llm", "tests/llm"):
        shutil.rmtree(copy / folder, ignore_errors=True)
    for _ in range(2):
        code = "import __spark_entry__ as e, bench, ledgerloom.__main__; from ledgerloom.plans import queries as q; assert set(e.queries()) == set(q.QUERIES) and set(e.oracle_sql()) == set(q.ORACLES)"
        subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, check=True)
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
