"""The library without the corpus operators: the entry imports, and the other tests are found."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LEFT = "q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q)"


def run(folder, *args: str) -> str:
    """Run Python there, before whatever the caller's path holds; what it says, and an error that shows it."""
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([str(folder), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))])}
    done = subprocess.run([sys.executable, *args], cwd=folder, env=env, timeout=300, capture_output=True, text=True)
    assert done.returncode == 0, f"{args} ended with {done.returncode}\n{done.stdout}\n{done.stderr}"
    return done.stdout


def test_entry_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    os.makedirs(copy)
    for name in ("gridloom", "tests"):
        shutil.copytree(f"{ROOT}/{name}", copy / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", copy)
    run(copy, "-c", f"import __spark_entry__ as e; {LEFT} and not any(k.startswith('op') or k == 'pipeline' for k in q)")
    assert "test_query" in run(copy, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider")


@pytest.mark.parametrize("name", ["ahocorasick", "public_tokenizers"])
def test_entry_without_a_library(name):
    hidden = f"import sys; sys.modules[{name!r}] = None"
    run(ROOT, "-c", f"{hidden}; import __spark_entry__ as e; {LEFT}")
