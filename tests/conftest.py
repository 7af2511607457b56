import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_MED = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pricewise.session import get_session
    scratch = tempfile.mkdtemp(prefix="pricewise-test-", dir="/tmp")
    s = get_session("local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                           "spark.local.dir": os.path.join(scratch, "local"),
                           "spark.driver.memory": "8g"})
    yield s
    s.stop()
