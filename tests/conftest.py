import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(tmp_path):
    return str(tmp_path)


@pytest.fixture(scope="session")
def rows():
    """Sorted plain tuples of a DataFrame, NULLs first."""

    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        key = lambda r: tuple((v is not None, str(v)) for v in r)
        return sorted((tuple(r) for r in chosen.collect()), key=key)

    return collect


@pytest.fixture(scope="session")
def plan():
    """The physical plan text of a DataFrame."""
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
