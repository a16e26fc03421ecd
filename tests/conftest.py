import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reviewlake.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="reviewlake-tests")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from reviewlake.session import scratch_dir

    return lambda *parts: scratch_dir(spark, "tests", *parts)
