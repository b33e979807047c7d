"""Every query that SQL can repeat, on the smallest test tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check import compare, connect  # noqa: E402

from lexiframe import queries as registry  # noqa: E402

SF = "/root/testdata/sf0.001"
registry.load_all()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_sql(spark, con, name):
    verdict = compare(registry.QUERIES[name](spark, SF), con, registry.ORACLES[name])
    assert verdict.startswith("ok") and "TYPES" not in verdict, verdict
