import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from newsgraph.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=8, app="newsgraph-tests")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    def collect(frame, *columns):
        chosen = frame.select(*columns) if columns else frame
        return sorted((tuple(r) for r in chosen.collect()), key=repr)
    return collect
