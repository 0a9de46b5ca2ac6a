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
    from wattlake.session import build_session
    s = build_session("local[4]", 8, app_name="wattlake-tests")
    s.sparkContext.setLogLevel("ERROR")
    # tests are the one place that picks its own shared folder, only if the session has none
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wattlake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    """A fresh folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="wattlake-test-")
