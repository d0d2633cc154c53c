import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from almanac.session import build_session
    ckpt = tempfile.mkdtemp(prefix="almanac-test-ckpt-")
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMOKE_DIR
