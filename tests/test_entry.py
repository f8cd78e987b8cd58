"""The entry module on copies of the repository that lack its optional parts."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = """
import __spark_entry__ as e
from lakeguard.queries import ORACLE_SQL, QUERIES
names, sql = set(e.queries()), set(e.oracle_sql())
assert set(QUERIES) <= names and set(ORACLE_SQL) <= sql and sql <= names
print(len(QUERIES), len(names), "pipeline" in names)
"""


def ask(folder: Path) -> list[str]:
    done = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("leftover", [False, True])
def test_entry_without_the_training_data_package(tmp_path, leftover):
    """Also with corpus_pipeline.py still there and with an empty folder left behind."""
    shutil.copytree(ROOT / "lakeguard", tmp_path / "lakeguard", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    if leftover:
        (tmp_path / "lakeguard" / "llm").mkdir()
    own, names, pipeline = ask(tmp_path)
    assert own == names and pipeline == "False"
