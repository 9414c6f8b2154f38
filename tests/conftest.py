import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from transferlake.session import build_session
    s = build_session("local[4]", "transferlake-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    """A fresh folder under the shared checkpoint dir."""
    from transferlake.session import shared_dir
    return shared_dir(spark, "tests", unique=True)


@pytest.fixture()
def local_tmp():
    return tempfile.mkdtemp(prefix="transferlake-test-")
