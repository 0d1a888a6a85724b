import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

@pytest.fixture(scope="session")
def spark():
    from critiq.session import build_session, shared_root

    session = build_session("local[*]", shuffle_partitions=8, app_name="critiq-tests")
    shared_root(session)  # unset in tests: a local checkpoint folder of its own
    yield session
    session.stop()
