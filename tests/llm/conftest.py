import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from shoprank.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return get_session("shoprank-tests", master="local[4]", shuffle_partitions=8, extra={
        "spark.driver.memory": "4g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="shoprank-test-ckpt-")})


@pytest.fixture(scope="session")
def docs(spark):
    """Ids and texts with nulls, empty and repeated rows, and a column whose name clashes."""
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    near = base[:18] + ["changed"] + base[19:]
    rows = [(1, " ".join(base)), (2, " ".join(base)), (2, " ".join(base)), (3, " ".join(near) + " phi chi psi omega"),
            (4, " ".join(base + ["one"])), (5, None), (6, ""), (7, "few words"), (8, "Few  WORDS"), (None, " ".join(base)),
            (9, "word " * 3000), (10, "éèê " * 300), (11, " ".join(base).upper())]
    return spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, key string")
