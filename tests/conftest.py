import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace import local_session, scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    scratch.clear(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("MILLRACE_SF_DIR", "/root/testdata/sf0.001")


def rows(df, *columns):
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
