import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barsmith.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="barsmith-tests")
    yield s
    s.stop()
