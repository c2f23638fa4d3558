"""The driver's entry points, with and without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from lakeretrieve.registry import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_imports_without_the_subpackage(tmp_path, with_pipeline):
    shutil.copytree(f"{ROOT}/lakeretrieve", tmp_path / "lakeretrieve", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py", *["corpus_pipeline.py"] * with_pipeline]:
        shutil.copy(f"{ROOT}/{name}", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(set(e.oracle_sql()) - set(e.queries())))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), "0"]


def test_every_oracle_has_a_query():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
