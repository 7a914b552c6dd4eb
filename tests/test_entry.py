"""The entry imports whichever of the removable parts are there."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') or n == 'pipeline' for n in e.queries()))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_without_text_operators(tmp_path, with_pipeline):
    shutil.copytree(ROOT / "shelfsight", tmp_path / "shelfsight", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if with_pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    done = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    every, text = map(int, done.stdout.split())
    assert every > 100 and text == 0
