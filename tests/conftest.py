import pytest

from tablefolio.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
