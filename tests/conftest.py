import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpusprep.session import local_session

    s = local_session("*", shuffle_partitions=8, app="corpusprep-tests")
    yield s
    s.stop()
