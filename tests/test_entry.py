"""The entry without the optional subpackage, with and without the pipeline module that needs it."""

import os
import shutil
import subprocess
import sys

import pytest

from refloom.catalog import load

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); print(len(q), len(s), any(n.startswith('op') or n == 'pipeline' for n in s))"


@pytest.mark.parametrize("pipeline", [True, False])
@pytest.mark.parametrize("empty_folder", [True, False])
def test_entry_without_the_subpackage(tmp_path, pipeline, empty_folder):
    left_out = {"llm", ".git"} | (set() if pipeline else {"corpus_pipeline.py"})
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: left_out.intersection(names))
    if empty_folder:
        (copy / "refloom" / "llm").mkdir()
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
    with_sql = [n for n, q in load().items() if q.sql]
    assert out.stdout.split() == [str(len(load())), str(len(with_sql)), str(any(n.startswith("op") for n in with_sql))]


def test_other_missing_modules_are_errors(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: {".git"}.intersection(names))
    if not (copy / "refloom" / "llm").exists():
        pytest.skip("the subpackage is not installed")
    path = copy / "refloom" / "llm" / "queries.py"
    path.write_text("import no_such_module\n" + path.read_text().replace("from __future__ import annotations", ""))
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.returncode != 0 and "no_such_module" in out.stderr
