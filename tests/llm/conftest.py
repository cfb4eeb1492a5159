import os

import pytest

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def data():
    if not os.path.isdir(DATA):
        pytest.skip("benchmark tables not present")
    return DATA
