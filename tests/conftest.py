from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from editsieve.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="editsieve-tests", memory="4g", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


def rows(df, *cols):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)
