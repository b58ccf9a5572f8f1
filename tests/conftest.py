import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from verbum.session import build_session, checkpoint_root

    s = build_session(master="local[4]", app="verbum-tests", shuffle_partitions=8)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture
def lines(spark):
    def make(values):
        return spark.createDataFrame([(v,) for v in values], "value string")
    return make
