import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = {
    "0.001": "/root/testdata/sf0.001",
    "0.01": "/root/testdata/sf0.01",
}


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import local_session
    scratch = tempfile.mkdtemp(prefix="tillroll-tests-")
    session = local_session("*", shuffle_partitions=8, app="tillroll-tests", scratch=scratch)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF["0.001"]
