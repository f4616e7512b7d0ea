"""The library without the optional subpackage: a copy of the tree that lacks it."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {copy!r})
import __spark_entry__ as e
assert e.__file__.startswith({copy!r})
from tidepool.session import build_session
spark = build_session("local[2]", 4)
print("ROWS", e.entry(spark).count(), len(e.queries()), "pipeline" in e.queries(), any(n.startswith("op") for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))
"""


def copied(folder: str, without: list[str]) -> str:
    """The tree without some of its paths."""
    copy = os.path.join(folder, "copy")
    shutil.copytree(REPO, copy, ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(d, n), REPO) in without])
    return copy


def run(copy: str, *command: str) -> subprocess.CompletedProcess:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, *command], cwd=copy, env=env, capture_output=True, text=True, timeout=600)


@pytest.mark.parametrize("without", [["tidepool/llm", "tests/llm"], ["tidepool/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_without_the_subpackage(tmp_path, without):
    copy = copied(str(tmp_path), without)
    out = run(copy, "-c", SCRIPT.format(copy=copy))
    assert "ROWS 106" in out.stdout and "False False True" in out.stdout, out.stderr[-2000:]
    if "corpus_pipeline.py" not in without:
        tests = run(copy, "-m", "pytest", "-q", "-x", "tests/test_inventory.py", "tests/test_shipping.py")
        assert tests.returncode == 0, tests.stdout[-2000:]


def test_other_missing_modules_are_errors(tmp_path):
    """Only the subpackage is optional: a module that it needs and that is missing is not excused."""
    copy = copied(str(tmp_path), [])
    with open(os.path.join(copy, "corpus_pipeline.py"), "a") as f:
        f.write("\nimport no_such_module_here\n")
    out = run(copy, "-c", "import sys; sys.path.insert(0, '.'); import __spark_entry__")
    assert "no_such_module_here" in out.stderr and out.returncode != 0
