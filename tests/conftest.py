import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"

# Tests that boot an embedded (in-process, in-memory) Derby database for the JDBC sink.
# No database may be started by default, so they run only on request.
needs_database = pytest.mark.skipif(
    os.environ.get("TXFLOW_DB_TESTS") != "1",
    reason="boots an embedded Derby database; run with TXFLOW_DB_TESTS=1")
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from txflow.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="txflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    """A fresh folder per test (never reused, never cleared)."""
    return str(tmp_path)
