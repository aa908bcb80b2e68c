import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session(master="local[*]", app="tidemark-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    """A fresh folder per test (never reused, never cleared)."""
    return str(tmp_path)
