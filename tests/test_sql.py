"""Every registered query with SQL gives the same whole result on Spark and in DuckDB."""

import os

import pytest

from tablefolio.plans.catalogue import load
from tests.check_sql import compare, duck

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
CATALOGUE = load()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n, q in CATALOGUE.items() if q.sql])
def test_same_as_sql(spark, con, name):
    rows, difference = compare(spark, con, SF, CATALOGUE[name])
    assert difference is None


@pytest.mark.parametrize("name", [n for n, q in CATALOGUE.items() if not q.sql])
def test_runs(spark, name):
    assert CATALOGUE[name].run(spark, SF).count() > 0
