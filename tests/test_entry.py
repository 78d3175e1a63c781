"""The registry with and without its optional parts."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
LIST = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())), any(q.startswith('op') and q[2].isdigit() or q == 'pipeline' for q in e.queries()))"


def registered(folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONDONTWRITEBYTECODE": "1"}
    return subprocess.run([sys.executable, "-c", LIST], cwd=folder, env=env, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("gone", [["weftline/llm"], ["weftline/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"], []])
def test_registry_imports_without_optional_parts(tmp_path, gone):
    leave = {str(REPO / name) for name in gone}
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=lambda at, names: [n for n in names if f"{at}/{n}" in leave or n in (".git", "__pycache__", "tests")])
    done = registered(copy)
    assert done.returncode == 0, done.stderr
    count, oracles, optional = done.stdout.split()
    assert int(count) > 100 and oracles == "[]"
    if "weftline/llm" in gone:
        assert optional == "False"


def test_other_import_errors_are_not_hidden(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=lambda at, names: [n for n in names if n in (".git", "__pycache__", "tests")])
    (copy / "corpus_pipeline.py").write_text("import a_module_that_is_not_there\n")
    done = registered(copy)
    assert done.returncode != 0 and "a_module_that_is_not_there" in done.stderr
