"""The library without its llm subpackage: the entry point still imports and
registers everything else."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(folder) -> set[str]:
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(folder)}, check=True).stdout
    return set(out.split())


def test_entry_imports_without_llm(tmp_path):
    from barlab.plans.catalog import QUERIES

    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(os.path.join(ROOT, "barlab"), tmp_path / "barlab", ignore=skip)
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    assert _names(tmp_path) == set(QUERIES)
    # An emptied folder of that name makes no difference.
    (tmp_path / "barlab" / "llm").mkdir()
    assert _names(tmp_path) == set(QUERIES)


def test_nothing_else_imports_llm():
    for folder, _, files in os.walk(os.path.join(ROOT, "barlab")):
        if os.path.basename(folder) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                assert "barlab.llm" not in open(os.path.join(folder, f), encoding="utf-8").read(), f
