import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = os.environ.get("GOVLAKE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from govlake.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="govlake-tests")
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
