import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shelfmark.session import local_session  # noqa: E402


# Column expressions need a running session, also while test modules are imported.
SESSION = local_session("4", "shelfmark-tests")
SESSION.conf.set("spark.sql.shuffle.partitions", "2")


@pytest.fixture(scope="session")
def spark():
    return SESSION
