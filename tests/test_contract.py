"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
import check

SF = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()
# Queries that fit models take minutes on all zones; tests/test_jobs.py fits small ones.
NAMES = [name for name in contract.queries() if name in ORACLES]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def db():
    return check.database(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, db, name):
    got = contract.queries()[name](spark, SF).toPandas()
    assert check.compare(name, got, db.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    assert contract.entry(spark).count() == 2


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())
