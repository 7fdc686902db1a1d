import pytest

from stayledger.settings import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", shuffle_partitions=4)
    yield session
    session.stop()
