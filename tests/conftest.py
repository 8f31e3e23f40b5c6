import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ.setdefault("PYTHONPATH", ROOT)


@pytest.fixture(scope="session")
def spark():
    from tabspark.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="tabspark-tests")
    yield s
    s.stop()
