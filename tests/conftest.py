import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from corpusprep.session import build_session, checkpoint_dir
    s = build_session("corpusprep-tests", master="local[4]", shuffle_partitions=4)
    checkpoint_dir(s)  # sets a private folder only when the session names none
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="corpusprep-test-")
