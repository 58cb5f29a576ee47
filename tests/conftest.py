from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from lectern.session import build_session  # noqa: E402

SF_DIR = os.environ.get("LECTERN_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = str(tmp_path_factory.mktemp("scratch"))
    session = build_session(os.environ.get("LECTERN_TEST_CPUS", "8"), app="tests", shuffle_partitions=4, scratch=scratch)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
