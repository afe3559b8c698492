import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"
SF_SMALL = f"{TESTDATA}/sf0.001"
SF_MID = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from corpusforge.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="corpusforge-tests")
    yield s
    s.stop()


def needs(path):
    return pytest.mark.skipif(not os.path.exists(path), reason=f"{path} not present")
