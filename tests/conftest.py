import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HERE = os.path.dirname(os.path.abspath(__file__))
for _p in (ROOT, HERE):
    if _p not in sys.path:
        sys.path.insert(0, _p)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from blotter.plans.execution import build_session, ensure_checkpoint_dir
    s = build_session("local[8]", shuffle_partitions=8)
    # Tests only: a private checkpoint folder when the session names none.
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="blotter-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="blotter-test-", dir="/tmp")
