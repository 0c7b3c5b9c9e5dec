"""The library stands without the training-data subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
CORE = "import __spark_entry__ as e; from ledgerloom.plans import catalog, oracle; "


@pytest.mark.parametrize("gone", [(), ("ledgerloom/llm",), ("ledgerloom/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_queries_without_the_subpackage(tmp_path, gone):
    copy = tmp_path / "repo"
    copy.mkdir()
    skip = {str(REPO / g) for g in gone}
    ignore = lambda folder, names: [n for n in names if f"{folder}/{n}" in skip or n == "__pycache__"]
    shutil.copytree(REPO / "ledgerloom", copy / "ledgerloom", ignore=ignore)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if str(REPO / name) not in skip and (REPO / name).exists():
            shutil.copy(REPO / name, copy / name)
    if "ledgerloom/llm" in gone:  # a left-over empty folder must not pass for the package
        (copy / "ledgerloom" / "llm").mkdir()
    check = CORE + "assert set(catalog.builders()) <= set(e.queries()); assert set(oracle.statements()) <= set(e.oracle_sql())"
    if gone:
        check += "; assert 'pipeline' not in e.queries()"
    ran = subprocess.run([sys.executable, "-c", check], cwd=copy, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr[-2000:]
