"""The entry point without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from workload import QUERIES

REPO = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("gone", [("cohortloom/llm",), ("cohortloom/llm", "corpus_pipeline.py")])
def test_entry_point_without_subpackage(tmp_path, gone):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *[Path(g).name for g in gone])
    shutil.copytree(REPO, copy, ignore=left_out)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) == set(e.queries())"
    ran = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    assert ran.stdout.split() == sorted(QUERIES)
