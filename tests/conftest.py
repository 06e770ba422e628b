import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from panelforge.session import build_session, checkpoint_dir
    s = build_session(master="local[4]", shuffle_partitions=4, app="panelforge-tests", driver_memory="4g")
    checkpoint_dir(s)      # unset in tests: a private folder is registered
    yield s
    s.stop()
