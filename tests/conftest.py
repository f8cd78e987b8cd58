from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lakeguard.session import build_session
    scratch = tempfile.mkdtemp(prefix="lakeguard-test-")
    session = build_session("local[4]", shuffle_partitions=8, app_name="lakeguard-tests",
                            extra={"spark.checkpoint.dir": f"{scratch}/checkpoints"})
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    from lakeguard.plans.lake import Lake
    return Lake(str(tmp_path / "lake"))
