import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from vitalgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def smoke_dir():
    return "/root/testdata/sf0.001"
