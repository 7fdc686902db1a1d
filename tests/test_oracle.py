"""Every query against its SQL, and the driver contract."""

import os

import pytest

import __spark_entry__
from tests.compare import differences, sample_tables
from workload.queries import REGISTRY

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = __spark_entry__.queries()
STATEMENTS = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return sample_tables(FOLDER)


def test_every_query_of_the_engine_has_a_statement():
    # Operators that SQL cannot express have brute-force tests of their own instead.
    assert set(REGISTRY) <= set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", STATEMENTS)
def test_query_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, FOLDER), duck, STATEMENTS[name]) == []


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0
