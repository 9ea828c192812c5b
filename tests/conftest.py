import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from support import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from cartwright.session import build_session

    spark = build_session(master="local[4]", shuffle_partitions=4,
                          extra_conf={"spark.driver.memory": "4g",
                                      "spark.sql.warehouse.dir":
                                          tempfile.mkdtemp(prefix="cartwright-test-wh-")})
    # Tests run in local mode, where a temporary checkpoint folder is valid.
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cartwright-test-ckpt-"))
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
