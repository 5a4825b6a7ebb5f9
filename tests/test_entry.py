"""The library without its optional parts."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("pipeline", [True, False])
def test_imports_without_the_optional_folders(tmp_path, pipeline):
    leave = shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"]))
    copy = shutil.copytree(ROOT, tmp_path / "copy", ignore=leave)
    code = ("import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q); "
            "assert 'pipeline' not in q and not any(n.startswith('op') for n in q)")
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
