import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from matchlake.session import get_spark

    s = get_spark("local[4]", app="matchlake-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from matchlake.session import scratch_dir

    return scratch_dir(spark, "test")


@pytest.fixture(autouse=True)
def nothing_cached(request):
    """What a test caches goes with it; others look for cached tables."""
    yield
    if "spark" in request.fixturenames:
        request.getfixturevalue("spark").catalog.clearCache()
