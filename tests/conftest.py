import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cardwatch.session import build_session, ensure_checkpoint_dir
    s = build_session("local[*]", shuffle_partitions=8, app_name="cardwatch-tests")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
