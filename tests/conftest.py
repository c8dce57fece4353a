import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dryspell.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # The checkpoint folder is taken from the configuration when set; only
    # when it is unset does the session helper create a scratch folder.
    s = build_session("local[4]", app_name="dryspell-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="dryspell-test-")
