import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from clasp.session import build_session
    extra = {}
    # tests set their own checkpoint folder only when the session has none
    ckpt = os.environ.get("CLASP_TEST_CKPT") or tempfile.mkdtemp(prefix="clasp-test-ckpt-")
    s = build_session("clasp-tests", master="local[4]", shuffle_partitions=8,
                      extra={"spark.driver.memory": "4g", **extra})
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", ckpt)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
