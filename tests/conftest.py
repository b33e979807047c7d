import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lexiframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Value of a column expression for one text."""

    def run(expression, text):
        from pyspark.sql import functions as F

        return spark.createDataFrame([(text,)], "t string").select(expression(F.col("t")).alias("r")).first()["r"]

    return run
