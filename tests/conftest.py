import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from candor.session import local_session

    s = local_session(os.environ.get("TEST_CPUS", "*"), shuffle_partitions=8, app="candor-tests")
    yield s
