import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from punctualis.session import local_session

    session = local_session(memory="4g", shuffle_partitions=4)
    session.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
