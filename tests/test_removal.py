"""The mining library and its queries stand without the training-data package."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_package(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(
        ".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache", "fixtures"))
    code = ("import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); "
            "assert 'pairs_join' in q and 'pipeline' not in q and set(s) <= set(q); "
            "assert not any(n.startswith('op') for n in q); print(len(q))")
    env = {**os.environ, "PYTHONPATH": str(copy)}
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout) >= 44


def test_nothing_else_names_the_package():
    for folder, _, files in os.walk(os.path.join(ROOT, "cofreq")):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py") and os.path.basename(os.path.dirname(os.path.join(folder, f))) != "llm":
                with open(os.path.join(folder, f), encoding="utf-8") as fh:
                    assert "cofreq.llm" not in fh.read(), f
