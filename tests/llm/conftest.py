import os

import pytest


@pytest.fixture(scope="session")
def sf():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables not present")
    return folder
