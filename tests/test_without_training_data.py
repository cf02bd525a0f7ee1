"""The entry module works where the training-data operators and their pipeline are removed."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

HOME = Path(__file__).resolve().parents[1]
SAYS = "import __spark_entry__ as e; q = e.queries(); print(len(q), sorted(n for n in q if n.startswith('op') and n[2].isdigit() or n == 'pipeline'))"


def test_entry_imports_without_them(tmp_path):
    left_out = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "tests")
    shutil.copytree(HOME, tmp_path / "repo", ignore=left_out)
    run = subprocess.run([sys.executable, "-c", SAYS], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    assert run.stdout.split(maxsplit=1)[1].strip() == "[]" and int(run.stdout.split()[0]) > 80
