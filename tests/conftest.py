import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=tempfile.mkdtemp(prefix="run-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, nulls first."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(row) for row in chosen.collect()), key=lambda r: [(v is not None, v) for v in r])

    return collect


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan():
    return physical_plan
