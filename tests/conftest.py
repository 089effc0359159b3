import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from commitlens.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture
def work(spark):
    from commitlens.session import scratch_path

    return scratch_path(spark, "test")
