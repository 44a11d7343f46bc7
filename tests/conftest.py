import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vintagelake import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session.build("local[8]", "tests", shuffle_partitions=4)
    yield s
    s.stop()
