"""The entry point on copies of the library without its optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from innlake.plans.catalog import QUERIES

ROOT = Path(__file__).resolve().parents[1]


def names(folder):
    code = "import __spark_entry__ as c; print(*c.queries()); print(*c.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True,
                          env={"PYTHONPATH": str(folder), "PATH": "/usr/bin:/bin"})
    return [set(line.split()) for line in done.stdout.splitlines()[-2:]]


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_training_data_operators(tmp_path, pipeline):
    shutil.copytree(ROOT / "innlake", tmp_path / "innlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    queries, sql = names(tmp_path)
    assert queries == set(QUERIES) and sql <= queries
