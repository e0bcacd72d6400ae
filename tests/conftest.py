import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from cohortkit.session import build_session
    # the tests' own shared folder, given when the session starts
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="cohortkit-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture
def tmp_out(spark):
    from cohortkit.session import scratch_path
    return scratch_path(spark, "test")
