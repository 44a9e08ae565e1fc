import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from rxlake.session import get_spark

    s = get_spark(app="rxlake-tests", master="local[*]", shuffle_partitions=8,
                  extra={"spark.driver.memory": "8g",
                         "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="rxlake-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from oracle import duck

    return duck(SMALL)


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rxlake-test-")
