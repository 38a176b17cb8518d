import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = {sf: f"/root/testdata/sf{sf}" for sf in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from kpiwatch.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, scratch=str(tmp_path_factory.mktemp("spark")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return DATA["0.001"]
