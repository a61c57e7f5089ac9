import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from rxlens.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    """One session; its scratch and warehouse folders belong to the test run."""
    base = tmp_path_factory.mktemp("spark")
    session = get_session(
        "rxlens-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Make a DataFrame of literal rows."""

    def make(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as tuples, sorted (by the given columns if any)."""
    if order:
        df = df.orderBy(*order)
        return [tuple(row) for row in df.collect()]
    return sorted((tuple(row) for row in df.collect()), key=repr)
