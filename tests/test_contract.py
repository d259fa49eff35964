"""The rest of the repository works without the optional corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as contract
from canton.workload import CHECKS, QUERIES

ROOT = Path(__file__).resolve().parents[1]
LOADED = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


def test_entry_without_corpus_operators(tmp_path):
    """A copy without both folders registers exactly the other queries, with the pipeline's module there or not."""
    skipped = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(ROOT / "canton", tmp_path / "canton", ignore=skipped)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    run = subprocess.run([sys.executable, "-c", LOADED], cwd=tmp_path, env={"PYTHONPATH": ""}, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    names, checked = (line.split() for line in run.stdout.splitlines())
    assert names == sorted(QUERIES) and checked == sorted(CHECKS)
    assert set(QUERIES) <= set(contract.queries())
