import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ordertide.session import local_session

    s = local_session(cores=4, shuffle_partitions=8, app="ordertide-tests")
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_DIR
