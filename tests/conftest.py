import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from pelagrid.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def one(spark):
    """Evaluate a Column over one row of named values."""

    def run(column, schema, *values):
        return spark.createDataFrame([tuple(values)], schema).select(column.alias("x")).first()["x"]

    return run
