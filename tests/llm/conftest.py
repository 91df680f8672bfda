import pytest

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
