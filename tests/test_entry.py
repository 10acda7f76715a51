"""The entry module stands without the optional folders."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT


def test_entry_imports_without_the_optional_folders(tmp_path):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", "corpus_pipeline.py", ".pytest_cache", ".hypothesis", "spark-warehouse")
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), set(o) <= set(q), any(k.startswith('op') for k in q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    n, known, optional = out.stdout.split()
    assert int(n) >= 50 and known == "True" and optional == "False"
