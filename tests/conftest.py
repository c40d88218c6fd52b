import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tillroll.session import build_session
    ckpt = tempfile.mkdtemp(prefix="tillroll-test-ckpt-")
    s = build_session("tillroll-tests", master="local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_lake():
    return tempfile.mkdtemp(prefix="tillroll-lake-")
