import pytest

from brindle.session import local_session
from tests.compare import connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("4", 4)


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def con():
    return connection(SF)
