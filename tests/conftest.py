import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tributary.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app_name="tributary-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_base(spark):
    from tributary.session import work_dir
    return work_dir(spark, "test")
