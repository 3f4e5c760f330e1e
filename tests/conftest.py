import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reedbed.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session(8, 4)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df, *cols):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
