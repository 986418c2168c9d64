import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tonearm.session import local_session

    s = local_session(8, app="tonearm-tests", shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()
