import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF = os.environ.get("TABLIGHT_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from tablight.session import local_session

    s = local_session("*", 8, "tablight-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
