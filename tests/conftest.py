import pytest

from leadvault.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
