import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from transitlens.config import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8)
    checkpoint_root(s)  # the configured spark.checkpoint.dir, or a temp folder where unset
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
