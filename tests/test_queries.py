"""Every registered query against its SQL, on whole tables."""

import os

import pytest

import __spark_entry__ as contract
from checks import queries, sql
from checks.compare import database, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert set(queries.registered()) == set(sql.registered())
    assert set(queries.registered()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries.registered()))
def test_query(spark, duck, name):
    ours = contract.queries()[name](spark, SF_DIR).toPandas()
    theirs = duck.execute(contract.oracle_sql()[name]).df()
    assert len(ours) > 0
    assert difference(ours, theirs) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
