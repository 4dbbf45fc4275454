import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = os.environ.get("SKYFRAME_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from skyframe.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app_name="skyframe-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="skyframe-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
