import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from docloom.session import local_session

    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate column expressions over one row of named values."""

    def run(expression, schema, *values):
        return spark.createDataFrame([values], schema).select(expression.alias("r")).first().r

    return run
