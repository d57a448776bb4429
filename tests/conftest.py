from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from slotwise.session import local_session

    session = local_session(shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A function giving fresh paths under the shared folder."""
    from slotwise.sources.scratch import new_folder

    return lambda purpose="test": new_folder(spark, purpose)


@pytest.fixture
def frame(spark):
    """Rows as a frame: ``frame(rows, "a string, b date")``."""
    return lambda rows, ddl: spark.createDataFrame(rows, ddl)


def rows(df, *columns):
    """Rows as a sorted list of tuples, nulls first."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
