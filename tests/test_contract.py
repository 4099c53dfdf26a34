"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import check
from __spark_entry__ import entry
from contract.oracle import ORACLE
from contract.queries import QUERIES
from contract.stored_oracle import STORED_ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE | STORED_ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note


def test_entry(spark):
    assert entry(spark).count() > 0
