import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparkqa.session import get_spark, ship_package
    ckpt = tempfile.mkdtemp(prefix="sparkqa-test-ckpt-")
    s = get_spark("local[4]", 4, app_name="sparkqa-tests", extra={"spark.checkpoint.dir": ckpt})
    ship_package(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
