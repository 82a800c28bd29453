"""Every registered query against its check text on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
CHECKS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    status, _, detail = compare(spark, con, SF_DIR, key, QUERIES[key], CHECKS.get(key))
    assert status in ("ok", "rows-only"), detail


def test_checks_belong_to_queries():
    assert set(CHECKS) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 10
