"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="session")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert oracle.compare(spark, duck, name, QUERIES[name], ORACLES.get(name), FOLDER) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
