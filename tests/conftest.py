from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from silverlode.plans.frames import Frames  # noqa: E402
from silverlode.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frames(spark):
    return Frames(spark, SMALL)


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)

    return collect


def explained(df) -> str:
    """Physical plan text."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan():
    return explained
