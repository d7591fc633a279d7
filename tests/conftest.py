import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tonescope.session import build_session  # noqa: E402
from tonescope.sources.layout import NAMES  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "true"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def event_line():
    """A whole event line with the given cells; dateAdded is set unless given."""
    def line(**cells):
        cells = {"dateAdded": "20240103"} | cells
        assert not set(cells) - set(NAMES)
        return "\t".join(str(cells.get(name, "")) for name in NAMES)
    return line


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples."""
    def collect(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)
    return collect
