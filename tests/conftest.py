import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from gridloom.session import local_session
    s = local_session(8)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("GRIDLOOM_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck_con(sf_dir):
    from tests.oracle import duck
    return duck(sf_dir)
