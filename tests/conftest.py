from __future__ import annotations

import pytest

from tests.session import new_session


@pytest.fixture(scope="session")
def spark():
    session = new_session()
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples (NULL first)."""

    def collect(df):
        found = [tuple(row) for row in df.collect()]
        return sorted(found, key=lambda row: [(v is not None, str(type(v)), v) for v in row])

    return collect


@pytest.fixture
def plan(capsys):
    """The physical plan as text."""

    def text(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    return text
