import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from saleswright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "4")


@pytest.fixture
def rows():
    """Collected rows as sorted tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
