import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from logfeat.session import local_session

    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("OFF")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    return session


@pytest.fixture(scope="session")
def data():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no driver tables")
    return path
