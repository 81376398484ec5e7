from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app_name="tidemark-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def scratch(tmp_path):
    """A fresh local folder per test (tests only; jobs use the checkpoint dir)."""
    return str(tmp_path)
