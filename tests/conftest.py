import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from landfall.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
    }, master="local[8]")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples, NaN as the text ``nan``."""
    def read(df):
        found = [
            tuple("nan" if isinstance(v, float) and v != v else v for v in r) for r in df.collect()
        ]
        return sorted(found, key=repr)

    return read


@pytest.fixture
def plan():
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
