"""The library, its registered queries and its tests stand without the optional operators."""

from __future__ import annotations

import pathlib
import re
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
OPTIONAL = ("corpus_pipeline.py", "llm")


@pytest.fixture(scope="module")
def rest(tmp_path_factory):
    """A copy of the repository without the optional files."""
    copy = tmp_path_factory.mktemp("rest")
    skip = shutil.ignore_patterns(*OPTIONAL, "__pycache__", ".git", ".pytest_cache")
    shutil.copytree(ROOT, copy, ignore=skip, dirs_exist_ok=True)
    return copy


def run(folder, *command):
    return subprocess.run([sys.executable, *command], cwd=folder, capture_output=True, text=True, timeout=300)


def test_entry_imports(rest):
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), *e.queries())"
    done = run(rest, "-c", code)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout.split()[0]) >= 296 and "pipeline" not in done.stdout


def test_tests_are_collected(rest):
    done = run(rest, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")
    assert done.returncode == 0, done.stdout


def test_nothing_else_names_the_optional_package():
    for path in (ROOT / "silverlode").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"\bllm\b", path.read_text()), path
