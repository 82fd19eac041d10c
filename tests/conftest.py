import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from varframe.session import local_session

    s = local_session(cores=8, partitions=8, app="varframe-tests")
    yield s
    s.stop()
