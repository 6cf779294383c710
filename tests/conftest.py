import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from flowtables.session import build_session

    s = build_session(master="local[4]", shuffle_partitions=4)
    # Tests run with no cluster setting, so they name their own folder.
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ft-test-ckpt-"))
    yield s
    s.stop()
