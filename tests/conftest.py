import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from skyflux.session import get_spark
    s = get_spark("local[4]", app="skyflux-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from skyflux.session import scratch_path
    return lambda name: scratch_path(spark, name)
