import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from meterline.session import build_session
    s = build_session("local[4]", app="meterline-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_table_dir(spark):
    from meterline.session import scratch_path
    return scratch_path(spark, "test")
