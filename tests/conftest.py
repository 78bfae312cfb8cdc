import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from offblock.session import local_session

    s = local_session(4, shuffle_partitions=8, app="offblock-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL
