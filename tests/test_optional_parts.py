"""The corpus operators and the pipeline are optional parts of the entry file."""

import os
import shutil
import subprocess
import sys

import pytest

from relaywatch.plans import ORACLE, QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = ("import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), "
         "'pipeline' in e.queries())")


@pytest.mark.parametrize("gone", [("relaywatch/llm", "tests/llm"),
                                  ("relaywatch/llm", "tests/llm", "corpus_pipeline.py")])
def test_other_queries_without_the_corpus_operators(tmp_path, gone):
    for name in ("relaywatch", "tests", "__spark_entry__.py", "corpus_pipeline.py"):
        src, dst = os.path.join(ROOT, name), tmp_path / name
        if os.path.isdir(src):
            shutil.copytree(src, dst, ignore=lambda d, names: [
                n for n in names if n == "__pycache__"
                or os.path.relpath(os.path.join(d, n), ROOT) in gone])
        elif name not in gone and os.path.exists(src):
            shutil.copy(src, dst)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, env=env, capture_output=True,
                         text=True, check=True).stdout.split()
    assert out == [str(len(QUERIES)), str(len(ORACLE)), "False"]
