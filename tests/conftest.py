import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from eventide.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app_name="eventide-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="eventide-test-ckpt-"))
    yield s
    s.stop()
