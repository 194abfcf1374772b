from __future__ import annotations

import pytest

from tallyframe.session import build_session


@pytest.fixture(scope="session")
def spark():
    options = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"}
    session = build_session("tests", "local[4]", **options)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a frame as a list of plain tuples, sorted unless ``ordered``."""

    def collect(df, *columns, ordered=False):
        found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
        return found if ordered else sorted(found, key=repr)

    return collect
