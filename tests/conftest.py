import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


@pytest.fixture(scope="session")
def spark():
    from tabspark.session import get_session
    s = get_session("local[8]", app="tabspark-tests", shuffle_partitions=8)
    yield s


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
