"""The driver's entry, with and without the optional text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())), sum(n[:2] == 'op' or n == 'pipeline' for n in e.queries()))"


def shown(folder):
    done = subprocess.run([sys.executable, "-c", SHOW], cwd=folder, capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": ""})
    n, unknown, optional = done.stdout.split()
    assert unknown == "[]"
    return int(n), int(optional)


def copied(to):
    keep = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse")
    return shutil.copytree(ROOT, to, ignore=keep)


def test_entry_without_the_text_operators(tmp_path):
    folder = copied(tmp_path / "repo")
    every, optional = shown(folder)
    for path in ("trueledger/llm", "tests/llm"):
        shutil.rmtree(folder / path, ignore_errors=True)
    assert shown(folder) == (every - optional, 0)  # the pipeline's file alone is of no use
    (folder / "corpus_pipeline.py").unlink(missing_ok=True)
    (folder / "trueledger/llm").mkdir()
    assert shown(folder) == (every - optional, 0)  # nor is a folder that was left behind
