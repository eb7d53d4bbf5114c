import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoprank.session import checkpoint_dir, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("shoprank-tests", master="local[4]", shuffle_partitions=8,
                    extra={"spark.driver.memory": "4g",
                           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shoprank-test-ckpt-")})
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shoprank-test-")


SF001 = "/root/testdata/sf0.001"
