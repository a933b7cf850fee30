"""One local session for all tests."""

import pytest

from leafwright.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", cpus=4, spark__sql__shuffle__partitions="4", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    yield session
    session.stop()
