import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from weftline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": shared,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of plain tuples."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect


def close(got, want, digits=6):
    assert len(got) == len(want), (got, want)
    for key, value in want.items():
        assert abs(got[key] - value) < 10**-digits * 1.5, (key, got[key], value)


@pytest.fixture
def near():
    return close
