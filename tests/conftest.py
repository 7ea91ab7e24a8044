import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_spark

    s = get_spark(cores=4, shuffle_partitions=4, app="quarry-tests")
    yield s
    s.stop()


def html_fixture(name: str) -> str:
    with open(os.path.join(FIXTURES, "html", name), encoding="utf-8") as f:
        return f.read()
