import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from trackmart.session import build_session
    ckpt = tempfile.mkdtemp(prefix="trackmart-test-ckpt-")
    warehouse = tempfile.mkdtemp(prefix="trackmart-test-warehouse-")
    s = build_session(master="local[*]", app_name="trackmart-tests", shuffle_partitions=8,
                      extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g",
                                  "spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
