import pytest

from quotelens.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(cpus=4, memory="6g", partitions=4, app="quotelens-tests")
