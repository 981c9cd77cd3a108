import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewell.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df):
    """A result as a sorted list of dictionaries."""
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: str(sorted(r.items(), key=str)))
