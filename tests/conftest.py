import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fipsight.session import local_session
    s = local_session(4, app="fipsight-tests", shuffle_partitions=8, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    import tempfile
    return tempfile.mkdtemp(prefix="fipsight-test-")
