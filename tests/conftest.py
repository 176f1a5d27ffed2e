import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from aerowx.session import get_spark
    conf = {"spark.ui.showConsoleProgress": "false"}
    s = get_spark("aerowx-tests", master="local[*]", shuffle_partitions=8, conf=conf)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="aerowx-test-ckpt-"))
    yield s
    s.stop()
