import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from kestrel.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("local[*]", app_name="kestrel-tests", shuffle_partitions=8)
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kestrel-test-ckpt-"))
    yield session


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="kestrel-test-")
