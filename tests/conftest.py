import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from editstream.session import build_session, checkpoint_root

    session = build_session("local[4]", app="editstream-tests", shuffle_partitions=4)
    # Uses the session's spark.checkpoint.dir; only when none is configured
    # does it create a folder of its own.
    checkpoint_root(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from editstream.plans.check import duck as connect
    return connect(SF_CHECK)
