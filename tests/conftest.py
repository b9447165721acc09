import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cotalake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "4", 4, spark__checkpoint__dir=str(shared), spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Sorted rows of a frame as tuples."""

    def collect(df, *order):
        chosen = df.select(*order) if order else df
        return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))

    return collect
